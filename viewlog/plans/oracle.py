"""DuckDB SQL for every registered query, written independently of the
DataFrame code. Tables ``events`` etc. are views over the same parquet files.

Sums are cast to BIGINT (DuckDB's ``sum`` returns HUGEINT) and every computed
column is aliased to the Spark name.
"""

from __future__ import annotations

# Snapshot cut-offs of the upsert query (see plans.queries.upsert_merge).
UPSERT_OLD_LAST_FILE = "20240120"
UPSERT_NEW_FIRST_FILE = "20240115"
EVOLVE_FIRST_FILE = "20240116"
SLICE_ROWS = 2500
# Rounds that the incremental ingest query takes for its longest file.
INGEST_ROUNDS = 4
# End-to-end pipeline query: day files per run, first run date; a run takes
# whole files.
FILES_PER_RUN = 5
FIRST_RUN_DATE = "2024-02-01"
SECOND_RUN_DATE = "2024-02-02"
THIRD_RUN_DATE = "2024-02-03"
# Stage status query: day files a batch, and the file of the second batch, which is not there.
STATUS_FILES = 10
MISSING_FILE = "19000101"
# Row-offset stream query: the first lot holds every so many events.
FIRST_LOT = 3
TOP_N = 10

BRONZE = """
bronze AS (
  SELECT CAST(user_id * 10 + CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS VARCHAR) AS Contract,
         json_extract_string(props, '$.k') AS Mac,
         CAST(round(value * 100) AS BIGINT) AS TotalDuration,
         (['CHANNEL', 'DSHD', 'KPLUS', 'KPlus', 'VOD', 'FIMS_RES', 'BHD_RES', 'VOD_RES',
           'FIMS', 'BHD', 'DANET', 'RELAX', 'CHILD', 'SPORT', 'OTHER'])[CAST(event_id % 15 + 1 AS INTEGER)] AS AppName,
         strftime(ts, '%Y-%m-%d') AS execution_date,
         strftime(ts, '%Y%m%d') AS source_file,
         event_id, event_type, ts
  FROM events
)"""

TYPED_SELECT = """
  SELECT *,
         CASE WHEN AppName IN ('CHANNEL', 'DSHD', 'KPLUS', 'KPlus') THEN 'Truyen_Hinh'
              WHEN AppName IN ('VOD', 'FIMS_RES', 'BHD_RES', 'VOD_RES', 'FIMS', 'BHD', 'DANET') THEN 'Phim_Truyen'
              WHEN AppName = 'RELAX' THEN 'Giai_Tri'
              WHEN AppName = 'CHILD' THEN 'Thieu_Nhi'
              WHEN AppName = 'SPORT' THEN 'The_Thao'
              ELSE 'Error' END AS Type
  FROM {src}"""
TYPED = "\ntyped AS (" + TYPED_SELECT + "\n)"


def _pivot_cols(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    cols = ["Error", "Giai_Tri", "Phim_Truyen", "The_Thao", "Thieu_Nhi", "Truyen_Hinh"]
    return ",\n         ".join(
        f"CAST(coalesce(sum({p}TotalDuration) FILTER (WHERE {p}Type = '{c}'), 0) AS BIGINT) AS {c}" for c in cols
    )


def silver_cte(src: str = "bronze", name: str = "silver") -> str:
    """Silver from a bronze-shaped relation ``src``: totals of non-NULL
    contracts, left-joined to their distinct (source_file, day)."""
    return f"""
{name}_typed AS ({TYPED_SELECT.format(src=src)}
),
{name}_totals AS (
  SELECT Contract,
         {_pivot_cols()},
         count(*) AS TotalDevices,
         count(DISTINCT Mac) AS DistinctDevices
  FROM {name}_typed WHERE Contract IS NOT NULL GROUP BY Contract
),
{name}_src AS (
  SELECT DISTINCT Contract, source_file, execution_date AS execution_day FROM {src} WHERE Contract IS NOT NULL
),
{name} AS (
  SELECT t.*, s.source_file, s.execution_day
  FROM {name}_totals t LEFT JOIN {name}_src s ON t.Contract = s.Contract
)"""


MOST_WATCH = """CASE greatest(Giai_Tri, Phim_Truyen, The_Thao, Thieu_Nhi, Truyen_Hinh)
           WHEN Giai_Tri THEN 'Giai_Tri' WHEN Phim_Truyen THEN 'Phim_Truyen'
           WHEN The_Thao THEN 'The_Thao' WHEN Thieu_Nhi THEN 'Thieu_Nhi'
           WHEN Truyen_Hinh THEN 'Truyen_Hinh' END"""

TASTE = """concat_ws('-', CASE WHEN Giai_Tri > 0 THEN 'Giai_Tri' END,
                     CASE WHEN Phim_Truyen > 0 THEN 'Phim_Truyen' END,
                     CASE WHEN The_Thao > 0 THEN 'The_Thao' END,
                     CASE WHEN Thieu_Nhi > 0 THEN 'Thieu_Nhi' END,
                     CASE WHEN Truyen_Hinh > 0 THEN 'Truyen_Hinh' END)"""


def gold_cte(silver: str = "silver", name: str = "gold") -> str:
    return f"""
{name}_active AS (
  SELECT Contract, count(DISTINCT execution_day) AS active_days,
         CASE WHEN count(DISTINCT execution_day) > 4 THEN 'High' ELSE 'Low' END AS Active
  FROM {silver} GROUP BY Contract
),
{name} AS (
  SELECT s.*, {MOST_WATCH} AS MostWatch, {TASTE} AS Taste, a.Active
  FROM {silver} s JOIN {name}_active a ON s.Contract = a.Contract
)"""


ALIGNED_COLS = """Contract, execution_day, source_file, Error, Giai_Tri, Phim_Truyen, The_Thao, Thieu_Nhi,
         Truyen_Hinh, TotalDevices, DistinctDevices, MostWatch, Taste, Active,
         CAST(NULL AS VARCHAR) AS Note, CAST(0 AS BIGINT) AS Score"""

CONTRACT_DAYS = """
cd AS (
  SELECT Contract, execution_day,
         max(Error) AS Error, max(Giai_Tri) AS Giai_Tri, max(Phim_Truyen) AS Phim_Truyen,
         max(The_Thao) AS The_Thao, max(Thieu_Nhi) AS Thieu_Nhi, max(Truyen_Hinh) AS Truyen_Hinh,
         max(TotalDevices) AS TotalDevices, max(MostWatch) AS MostWatch, max(Active) AS Active
  FROM gold WHERE Contract <> '0' GROUP BY Contract, execution_day
),
cdt AS (
  SELECT *, Error + Giai_Tri + Phim_Truyen + The_Thao + Thieu_Nhi + Truyen_Hinh AS total_duration FROM cd
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


GOLD_ALL = _with(BRONZE, silver_cte(), gold_cte())


def oracle_sql() -> dict[str, str]:
    typed_all = _with(BRONZE, TYPED.format(src="bronze"))
    q: dict[str, str] = {}
    q["category_map"] = typed_all + """
SELECT Contract, Mac, TotalDuration, AppName, Type, execution_date, source_file FROM typed"""
    q["device_count"] = _with(BRONZE) + """
SELECT Contract, count(*) AS TotalDevices, count(DISTINCT Mac) AS DistinctDevices
FROM bronze GROUP BY Contract"""
    q["duration_by_type"] = typed_all + """
SELECT Contract, Type, CAST(sum(TotalDuration) AS BIGINT) AS TotalDuration FROM typed GROUP BY Contract, Type"""
    q["usage_pivot"] = typed_all + f"""
SELECT Contract,
         {_pivot_cols()}
FROM typed GROUP BY Contract"""
    q["contract_sources"] = _with(BRONZE) + """
SELECT DISTINCT Contract, source_file FROM bronze"""
    q["silver_summary"] = _with(BRONZE, silver_cte()) + """
SELECT * FROM silver"""
    pivot = typed_all.rstrip("\n") + f""",
pv AS (
  SELECT Contract,
         {_pivot_cols()}
  FROM typed GROUP BY Contract
)
"""
    q["most_watch"] = pivot + f"SELECT Contract, {MOST_WATCH} AS MostWatch FROM pv"
    q["taste"] = pivot + f"SELECT Contract, {TASTE} AS Taste FROM pv"
    q["active_segment"] = _with(BRONZE, silver_cte()) + """
SELECT Contract, count(DISTINCT execution_day) AS active_days,
       CASE WHEN count(DISTINCT execution_day) > 4 THEN 'High' ELSE 'Low' END AS Active
FROM silver GROUP BY Contract"""
    q["gold_usage"] = GOLD_ALL + "SELECT * FROM gold"
    q["latest_snapshot"] = GOLD_ALL + "SELECT * FROM gold WHERE execution_day = (SELECT max(execution_day) FROM gold)"
    q["null_bucket_filter"] = GOLD_ALL + "SELECT * FROM gold WHERE Contract <> '0'"
    q["align_to_target"] = GOLD_ALL + f"SELECT {ALIGNED_COLS} FROM gold"
    q["dedup_on_key"] = _with(
        BRONZE, silver_cte(), gold_cte(),
        f"old_bronze AS (SELECT * FROM bronze WHERE source_file <= '{UPSERT_OLD_LAST_FILE}')",
        silver_cte("old_bronze", "old_silver"), gold_cte("old_silver", "old_gold"),
        "snaps AS (SELECT * FROM gold UNION ALL SELECT * FROM old_gold)",
    ) + """
SELECT * FROM snaps
QUALIFY row_number() OVER (PARTITION BY Contract, execution_day, source_file
                           ORDER BY Error DESC, Giai_Tri DESC, Phim_Truyen DESC, The_Thao DESC,
                                    Thieu_Nhi DESC, Truyen_Hinh DESC, TotalDevices DESC,
                                    DistinctDevices DESC, MostWatch DESC, Taste DESC, Active DESC) = 1"""
    old_bronze = f"old_bronze AS (SELECT * FROM bronze WHERE source_file <= '{UPSERT_OLD_LAST_FILE}')"
    q["upsert_merge"] = _with(
        BRONZE, silver_cte(), gold_cte(), old_bronze,
        silver_cte("old_bronze", "old_silver"), gold_cte("old_silver", "old_gold"),
        f"""
new_rows AS (SELECT {ALIGNED_COLS} FROM gold WHERE source_file >= '{UPSERT_NEW_FIRST_FILE}'),
old_rows AS (SELECT {ALIGNED_COLS} FROM old_gold)""",
    ) + """
SELECT o.* FROM old_rows o
WHERE NOT EXISTS (SELECT 1 FROM new_rows n WHERE n.Contract IS NOT DISTINCT FROM o.Contract
                  AND n.execution_day IS NOT DISTINCT FROM o.execution_day
                  AND n.source_file IS NOT DISTINCT FROM o.source_file)
UNION ALL
SELECT * FROM new_rows"""
    q["upsert_versions"] = _with(
        BRONZE, silver_cte(), gold_cte(), old_bronze,
        silver_cte("old_bronze", "old_silver"), gold_cte("old_silver", "old_gold"),
        f"""
new_rows AS (SELECT {ALIGNED_COLS} FROM gold WHERE source_file >= '{UPSERT_NEW_FIRST_FILE}'),
old_rows AS (SELECT {ALIGNED_COLS} FROM old_gold)""",
    ) + """
SELECT 1 AS version, o.* FROM old_rows o
UNION ALL
SELECT 2, o.* FROM old_rows o
WHERE NOT EXISTS (SELECT 1 FROM new_rows n WHERE n.Contract IS NOT DISTINCT FROM o.Contract
                  AND n.execution_day IS NOT DISTINCT FROM o.execution_day
                  AND n.source_file IS NOT DISTINCT FROM o.source_file)
UNION ALL
SELECT 2, n.* FROM new_rows n"""
    q["serving_lookup"] = _with(BRONZE, silver_cte(), gold_cte()) + f"""
SELECT {ALIGNED_COLS} FROM gold WHERE Contract = '0'"""
    q["maintained_views"] = _with(
        BRONZE, silver_cte(), gold_cte(), old_bronze,
        silver_cte("old_bronze", "old_silver"), gold_cte("old_silver", "old_gold"),
        f"""
new_rows AS (SELECT {ALIGNED_COLS} FROM gold WHERE source_file >= '{UPSERT_NEW_FIRST_FILE}'),
old_rows AS (SELECT {ALIGNED_COLS} FROM old_gold),
served AS (
  SELECT o.* FROM old_rows o
  WHERE NOT EXISTS (SELECT 1 FROM new_rows n WHERE n.Contract = o.Contract AND n.execution_day = o.execution_day AND n.source_file = o.source_file)
  UNION ALL SELECT n.* FROM new_rows n
),
days AS (SELECT * FROM served WHERE Contract <> '0'),
kpi AS (
  SELECT execution_day, count(*) AS contracts,
         CAST(sum(Error + Giai_Tri + Phim_Truyen + The_Thao + Thieu_Nhi + Truyen_Hinh) AS BIGINT) AS total_duration,
         CAST(sum(TotalDevices) AS BIGINT) AS total_devices
  FROM days GROUP BY execution_day
),
content AS (
  UNPIVOT (SELECT execution_day, CAST(sum(Giai_Tri) AS BIGINT) AS Giai_Tri, CAST(sum(Phim_Truyen) AS BIGINT) AS Phim_Truyen,
                  CAST(sum(The_Thao) AS BIGINT) AS The_Thao, CAST(sum(Thieu_Nhi) AS BIGINT) AS Thieu_Nhi,
                  CAST(sum(Truyen_Hinh) AS BIGINT) AS Truyen_Hinh FROM days GROUP BY execution_day)
  ON Giai_Tri, Phim_Truyen, The_Thao, Thieu_Nhi, Truyen_Hinh INTO NAME a VALUE n
)""",
    ) + """
SELECT 'v_kpi' AS view, execution_day, a, CAST(NULL AS VARCHAR) AS b, n
FROM (UNPIVOT kpi ON contracts, total_duration, total_devices INTO NAME a VALUE n)
UNION ALL SELECT 'v_content', execution_day, a, NULL, n FROM content
UNION ALL SELECT 'v_segment', execution_day, Active, MostWatch, count(*) FROM days GROUP BY execution_day, Active, MostWatch"""
    q["device_sketches"] = _with(BRONZE) + """
SELECT Contract, count(DISTINCT Mac) AS DistinctDevices, true AS within_bound FROM bronze GROUP BY Contract"""
    q["stream_device_count"] = _with(BRONZE) + """
SELECT Contract, count(DISTINCT Mac) AS DistinctDevices FROM bronze GROUP BY Contract"""
    q["resumed_run"] = _with(BRONZE) + f"""
SELECT g.source_file, strftime(DATE '{FIRST_RUN_DATE}' + CAST(g.b AS INTEGER), '%Y-%m-%d') AS run_date, s.stage, 'ok' AS status,
       CAST(CASE WHEN g.b = 1 AND s.stage = 'bronze' THEN 2 ELSE 1 END AS BIGINT) AS starts
FROM (
  SELECT string_agg(source_file, ',' ORDER BY source_file) AS source_file, b
  FROM (
    SELECT source_file, (row_number() OVER (ORDER BY source_file) - 1) // {STATUS_FILES} AS b
    FROM (SELECT DISTINCT source_file FROM bronze) d
  ) f GROUP BY b
) g, (SELECT unnest(['bronze', 'silver', 'gold', 'export']) AS stage) s"""
    q["v_kpi"] = _with(BRONZE, silver_cte(), gold_cte(), CONTRACT_DAYS) + """
SELECT execution_day, count(*) AS contracts, CAST(sum(total_duration) AS BIGINT) AS total_duration,
       CAST(sum(TotalDevices) AS BIGINT) AS total_devices
FROM cdt GROUP BY execution_day"""
    q["v_content"] = _with(BRONZE, silver_cte(), gold_cte(), CONTRACT_DAYS, """
per_day AS (
  SELECT execution_day, CAST(sum(Giai_Tri) AS BIGINT) AS Giai_Tri, CAST(sum(Phim_Truyen) AS BIGINT) AS Phim_Truyen,
         CAST(sum(The_Thao) AS BIGINT) AS The_Thao, CAST(sum(Thieu_Nhi) AS BIGINT) AS Thieu_Nhi,
         CAST(sum(Truyen_Hinh) AS BIGINT) AS Truyen_Hinh
  FROM cd GROUP BY execution_day
),
long AS (
  SELECT execution_day, 'Giai_Tri' AS category, Giai_Tri AS duration FROM per_day
  UNION ALL SELECT execution_day, 'Phim_Truyen', Phim_Truyen FROM per_day
  UNION ALL SELECT execution_day, 'The_Thao', The_Thao FROM per_day
  UNION ALL SELECT execution_day, 'Thieu_Nhi', Thieu_Nhi FROM per_day
  UNION ALL SELECT execution_day, 'Truyen_Hinh', Truyen_Hinh FROM per_day
),
tot AS (
  SELECT execution_day, Giai_Tri + Phim_Truyen + The_Thao + Thieu_Nhi + Truyen_Hinh AS day_total FROM per_day
)""") + """
SELECT l.execution_day, l.category, l.duration,
       CAST(l.duration AS DOUBLE) / NULLIF(CAST(t.day_total AS DOUBLE), 0) AS share
FROM long l JOIN tot t ON l.execution_day = t.execution_day"""
    q["v_segment"] = _with(BRONZE, silver_cte(), gold_cte(), CONTRACT_DAYS) + """
SELECT execution_day, Active, MostWatch, count(*) AS contracts FROM cd GROUP BY execution_day, Active, MostWatch"""
    q["v_top"] = _with(BRONZE, silver_cte(), gold_cte(), CONTRACT_DAYS) + f"""
SELECT CAST(row_number() OVER (ORDER BY total_duration DESC, Contract ASC) AS INTEGER) AS rank,
       Contract, execution_day, total_duration, MostWatch, Active
FROM cdt WHERE execution_day = (SELECT max(execution_day) FROM cdt)
ORDER BY total_duration DESC, Contract ASC LIMIT {TOP_N}"""
    q["checkpoint_latest"] = _with(BRONZE) + """
SELECT source_file AS file_name, event_id AS last_offset, TotalDuration AS rows_per_run
FROM bronze
QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY ts DESC, event_id DESC) = 1"""
    q["evolved_schema"] = _with(BRONZE) + f"""
SELECT Contract, Mac, TotalDuration, AppName, source_file, execution_date, CAST(NULL AS VARCHAR) AS EventType
FROM bronze WHERE source_file < '{EVOLVE_FIRST_FILE}'
UNION ALL
SELECT Contract, Mac, TotalDuration, AppName, source_file, execution_date, event_type AS EventType
FROM bronze WHERE source_file >= '{EVOLVE_FIRST_FILE}'"""
    q["offset_slice"] = _with(BRONZE) + f"""
SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS row_index,
       CAST((row_number() OVER (ORDER BY event_id) - 1) // {SLICE_ROWS} AS BIGINT) AS batch_id,
       Contract, Mac, TotalDuration, AppName, source_file
FROM bronze"""
    q["flatten_source"] = _with(BRONZE) + """
SELECT Contract, Mac, TotalDuration, AppName, event_type AS EventType,
       source_file AS meta_file, event_id AS meta_seq
FROM bronze"""
    q["file_stream_usage"] = q["usage_pivot"]
    q["incremental_ingest"] = _with(BRONZE) + """
SELECT Contract, Mac, TotalDuration, AppName, source_file,
       CAST(row_number() OVER (PARTITION BY source_file ORDER BY event_id) - 1 AS BIGINT) AS row_index
FROM bronze"""
    q["stream_ingest"] = q["incremental_ingest"]
    odd = BRONZE + """, odd AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY source_file ORDER BY event_id) - 1 AS BIGINT) AS row_index,
         event_id % 17 = 3 AS malformed, event_id % 19 = 5 AS no_payload, event_id % 23 = 7 AS no_app
  FROM bronze
), given AS (
  SELECT CASE WHEN NOT no_payload THEN Contract END AS Contract, CASE WHEN NOT no_payload THEN Mac END AS Mac,
         CASE WHEN NOT no_payload THEN TotalDuration END AS TotalDuration,
         CASE WHEN NOT no_payload AND NOT no_app THEN AppName END AS AppName, source_file, row_index
  FROM odd WHERE NOT malformed
)"""
    q["odd_records"] = _with(odd) + "SELECT * FROM given"
    q["ingest_rejects"] = _with(odd) + f"""
SELECT source_file, row_index, '{{"_id": ' || event_id || ', "_source": {{' AS line, '{FIRST_RUN_DATE}' AS execution_date
FROM odd WHERE malformed"""
    q["observed_counts"] = _with(odd) + """
SELECT 'read' AS what, count(*) AS n FROM odd
UNION ALL SELECT 'rejects', count(*) FROM odd WHERE malformed
UNION ALL SELECT 'silver', count(*) FROM (SELECT DISTINCT Contract, source_file FROM given WHERE Contract IS NOT NULL)
UNION ALL SELECT 'gold', count(*) FROM (SELECT DISTINCT Contract, source_file FROM given WHERE Contract IS NOT NULL)"""
    q["stage_status"] = _with(BRONZE) + f"""
SELECT g.source_file, strftime(DATE '{FIRST_RUN_DATE}' + CAST(g.k AS INTEGER), '%Y-%m-%d') AS run_date, s.stage,
       CASE WHEN g.found THEN 'ok' WHEN s.stage = 'bronze' THEN 'failed' ELSE 'skipped' END AS status
FROM (
  SELECT string_agg(source_file, ',' ORDER BY source_file) AS source_file, true AS found, CASE WHEN b > 0 THEN b + 1 ELSE 0 END AS k
  FROM (
    SELECT source_file, (row_number() OVER (ORDER BY source_file) - 1) // {STATUS_FILES} AS b
    FROM (SELECT DISTINCT source_file FROM bronze) d
  ) f GROUP BY b
  UNION ALL SELECT '{MISSING_FILE}', false, 1
) g, (SELECT unnest(['bronze', 'silver', 'gold', 'export']) AS stage) s"""
    q["registered_schema"] = _with(BRONZE) + f"""
SELECT Contract, Mac, source_file, CASE WHEN source_file < '{EVOLVE_FIRST_FILE}' THEN source_file END AS meta_file,
       event_type AS meta_file_2
FROM bronze"""
    q["created_from_frame"] = _with(BRONZE) + """
SELECT Contract, Mac, TotalDuration, AppName, execution_date, source_file FROM bronze"""
    q["table_preview"] = _with(BRONZE, silver_cte(), gold_cte()) + f"""
SELECT * FROM gold ORDER BY Contract, execution_day, source_file LIMIT {TOP_N}"""
    q["stream_offsets"] = _with(BRONZE) + f"""
SELECT Contract, Mac, TotalDuration, AppName, source_file, '{FIRST_RUN_DATE}' AS execution_date,
       CAST(row_number() OVER (PARTITION BY source_file ORDER BY event_id % {FIRST_LOT} <> 0, event_id) - 1 AS BIGINT) AS row_index
FROM bronze"""
    third = "CAST(source_file[7:8] AS INTEGER) % 3"
    q["evolved_siblings"] = _with(BRONZE.replace("event_id, event_type, ts", "event_id, event_type, ts, value")) + f"""
SELECT Contract, Mac, source_file, CASE WHEN {third} = 0 THEN event_id END AS extra,
       CASE WHEN {third} <> 1 THEN event_id END AS extra_double, CASE WHEN {third} <> 0 THEN value END AS extra_double_2
FROM bronze"""
    q["ledger_fold"] = _with(BRONZE, f"""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY event_id) AS line,
         count(*) OVER (PARTITION BY source_file) AS lines FROM bronze
),
seen AS (
  SELECT n.*, d.day FROM numbered n
  JOIN (SELECT unnest(['{FIRST_RUN_DATE}', '{SECOND_RUN_DATE}', '{THIRD_RUN_DATE}']) AS day) d
    ON d.day = '{THIRD_RUN_DATE}' OR n.line <= ((SELECT max(lines) FROM numbered) + 1) // 2
),
typed AS ({TYPED_SELECT.format(src="seen")}
),
totals AS (
  SELECT day, Contract, {_pivot_cols()},
         count(*) AS TotalDevices, count(DISTINCT Mac) AS DistinctDevices
  FROM typed WHERE Contract IS NOT NULL GROUP BY day, Contract
)""") + """
SELECT t.Contract, t.Error, t.Giai_Tri, t.Phim_Truyen, t.The_Thao, t.Thieu_Nhi, t.Truyen_Hinh,
       t.TotalDevices, t.DistinctDevices, s.source_file, t.day AS execution_day
FROM totals t JOIN (SELECT DISTINCT day, Contract, source_file FROM seen) s ON s.day = t.day AND s.Contract = t.Contract"""
    q["replayed_ingest"] = _with(BRONZE) + f"""
SELECT Contract, Mac, TotalDuration, AppName, source_file, row_index,
       CASE WHEN row_index < (n + 1) // 2 THEN '{FIRST_RUN_DATE}' ELSE '{SECOND_RUN_DATE}' END AS execution_date
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY source_file ORDER BY event_id) - 1 AS BIGINT) AS row_index,
             count(*) OVER (PARTITION BY source_file) AS n FROM bronze)"""
    kind = "CAST(source_file[7:8] AS INTEGER) % 3"
    q["evolved_types"] = _with(BRONZE.replace("event_id, event_type, ts", "event_id, event_type, ts, value")) + f"""
SELECT Contract, Mac, source_file, CASE WHEN {kind} = 0 THEN TotalDuration END AS extra,
       CASE WHEN {kind} = 1 THEN value END AS "Extra_double", CASE WHEN {kind} = 2 THEN event_type END AS "Extra_string"
FROM bronze"""
    q["pipeline_serving"] = _with(BRONZE, f"""
files AS (
  SELECT source_file, row_number() OVER (ORDER BY source_file) AS fno
  FROM (SELECT DISTINCT source_file FROM bronze) d
),
runs AS (
  SELECT DISTINCT CAST((fno - 1) // {FILES_PER_RUN} + 1 AS INTEGER) AS k FROM files
),
rd AS (
  SELECT k, strftime(DATE '{FIRST_RUN_DATE}' + (k - 1), '%Y-%m-%d') AS run_date FROM runs
),
bk AS (
  SELECT rd.k, rd.run_date, x.*
  FROM rd JOIN files f ON f.fno <= rd.k * {FILES_PER_RUN} JOIN bronze x ON x.source_file = f.source_file
),
typed AS ({TYPED_SELECT.format(src="bk")}
),
tot AS (
  SELECT k, Contract,
         {_pivot_cols()},
         count(*) AS TotalDevices, count(DISTINCT Mac) AS DistinctDevices
  FROM typed WHERE Contract IS NOT NULL GROUP BY k, Contract
),
src AS (SELECT DISTINCT k, run_date, Contract, source_file FROM bk WHERE Contract IS NOT NULL),
silver AS (
  SELECT t.*, s.source_file, s.run_date AS execution_day
  FROM tot t JOIN src s ON t.k = s.k AND t.Contract = s.Contract
),
first_run AS (SELECT Contract, min(k) AS k0 FROM src GROUP BY Contract),
gold AS (
  SELECT s.*, {MOST_WATCH} AS MostWatch, {TASTE} AS Taste,
         CASE WHEN s.k - fr.k0 + 1 > 4 THEN 'High' ELSE 'Low' END AS Active
  FROM silver s JOIN first_run fr ON s.Contract = fr.Contract
)""") + f"SELECT {ALIGNED_COLS} FROM gold"
    q["pipeline_serving_incremental"] = q["pipeline_serving"]
    return q
