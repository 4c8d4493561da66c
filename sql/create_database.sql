-- K7: the bronze database. `owner` is a reserved property name in Spark,
-- so the owner is kept as `data_owner`.
CREATE DATABASE IF NOT EXISTS {database}
COMMENT 'Policy tables: bronze (typed, latest row per policy)'
LOCATION '{location}'
WITH DBPROPERTIES ('data_owner' = 'policy data team', 'description' = 'one row per policy, by day');
