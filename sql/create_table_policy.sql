-- K8: a catalog entry over bronze files that already exist. Spark needs the
-- columns and the partition columns; the repair then registers the
-- partitions found under the location (without it the table reads no rows).
CREATE TABLE IF NOT EXISTS {database}.policy (
  policy_id      BIGINT,
  expiry_date    DATE,
  location_name  STRING,
  state_code     STRING,
  region_name    STRING,
  insured_value  DOUBLE,
  business_type  STRING,
  earth_quake    STRING,
  flood          STRING,
  file_name      STRING,
  year_month_day STRING,
  year           STRING,
  month          STRING,
  day            STRING
)
USING parquet
PARTITIONED BY (year, month, day)
LOCATION '{table_location}';

MSCK REPAIR TABLE {database}.policy;
