/* One row per second; the next script reads it. */
CREATE OR REPLACE TEMPORARY VIEW scripted_seconds AS
SELECT user_id, frame div 4 AS second, count_if(event_type = 'click') AS clicks
FROM scripted_frames
GROUP BY user_id, frame div 4;
