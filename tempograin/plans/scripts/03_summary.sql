SELECT user_id, count(*) AS seconds, sum(clicks) AS clicks, count_if(clicks >= :busy) AS busy_seconds
FROM IDENTIFIER(:source)
GROUP BY user_id;
