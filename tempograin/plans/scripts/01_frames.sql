-- Events as frames of a quarter of a second.
CREATE OR REPLACE TEMPORARY VIEW scripted_frames AS
SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS frame
FROM scripted_events;
