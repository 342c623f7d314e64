"""The queries again as SQL, written from the definitions of the results."""

from __future__ import annotations

from workload.queries import nudge, places

# The tables seen as telemetry

GPU_TS = """gpu_ts AS (
  SELECT l_suppkey AS job_id, concat('r', CAST(l_linenumber AS VARCHAR)) AS node_id,
         CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS BIGINT) AS gpu_index,
         l_shipdate AS ts, l_quantity * 2 AS util_pct, round(l_discount * 1000) AS mem_util_pct,
         CAST(floor(l_extendedprice) AS DOUBLE) AS mem_used_kib, 80 + l_quantity * 4 AS power_w,
         round(30 + l_tax * 500) AS temperature
  FROM lineitem)"""

CPU_TS = """cpu_ts AS (
  SELECT user_id AS job_id, event_type AS node_id, ts, floor(value) / 4.0::DOUBLE AS cpu_util_pct,
         floor(value) * 10.0::DOUBLE AS mem_rss_kb, k * 100 AS mem_avail_kb,
         CASE WHEN k > 0 THEN floor(value) * 10.0::DOUBLE / (k * 100) END AS mem_pct_utilization,
         k * 1024.0::DOUBLE AS read_kb, CAST(event_id % 100 AS DOUBLE) * 1024 AS write_kb
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) e)"""

JOBS = """jobs AS (
  SELECT *, CASE WHEN runtime_seconds > 0 THEN num_nodes * runtime_seconds / 3600.0::DOUBLE END AS node_hours,
         CASE WHEN runtime_seconds > 0
              THEN num_nodes * runtime_seconds * num_alloc_gpus / 3600.0::DOUBLE END AS gpu_hours,
         CASE WHEN cpus_req > 0 THEN cpus_req / CASE WHEN num_nodes <= 0 THEN 1.0::DOUBLE ELSE num_nodes END END
           AS cpus_per_node
  FROM (
    SELECT o_orderkey AS job_id, o_orderstatus, CAST(epoch(o_orderdate) AS BIGINT) AS start_s,
           CAST(epoch(end_ts) AS BIGINT) AS end_s, o_orderdate AS start_ts,
           CAST(coalesce(epoch(end_ts) - epoch(o_orderdate), 0) AS BIGINT) AS runtime_seconds,
           CAST(CASE WHEN o_orderkey % 89 <> 0 THEN nodes END AS DOUBLE) AS num_nodes,
           CAST(CASE WHEN o_orderkey % 4 IN (1, 2) THEN o_orderkey % 5 ELSE 0 END AS INTEGER) AS num_alloc_gpus,
           CASE o_orderkey % 4 WHEN 1 THEN 'tesla' WHEN 2 THEN 'volta' END AS gpu_type,
           CAST(o_custkey AS VARCHAR) AS user_id, concat(' ', o_orderpriority, ' ') AS queue_name,
           CASE o_orderstatus WHEN 'O' THEN '0' WHEN 'F' THEN '1' END AS exit_code,
           CAST(o_orderkey % 17 AS DOUBLE) AS cpus_req
    FROM orders LEFT JOIN (
      SELECT l_orderkey, max(l_shipdate) AS end_ts, count(DISTINCT l_suppkey) AS nodes
      FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey) o)"""

OVERVIEW = """ov AS (
  SELECT job_id, strftime(start_ts, '%Y-%m') AS month, CAST(isodow(start_ts) - 1 AS INTEGER) AS day_of_week,
         CAST(start_ts AS DATE) AS date, lower(trim(queue_name)) AS partition, num_alloc_gpus > 0 AS is_gpu_job,
         runtime_seconds / 3600.0::DOUBLE AS runtime_hours, coalesce(exit_code, '0') = '0' AS is_success,
         num_nodes, node_hours, gpu_hours
  FROM jobs WHERE runtime_seconds > 10)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def r(expression: str, name: str) -> str:
    value = f"round(({expression}) + {nudge(name)!r}::DOUBLE, {places(name)})"
    return f"CASE WHEN {value} = 0 THEN 0.0::DOUBLE ELSE CAST({value} AS DOUBLE) END AS {name}"


# Series statistics

STATS = ("mean", "max", "min", "std", "skew", "kurtosis", "iof")
GPU_METRICS = {
    "gpu_util": "util_pct", "gpu_mem_util": "mem_util_pct", "gpu_mem_used_kib": "mem_used_kib",
    "gpu_temp": "temperature", "gpu_power": "power_w",
}
CPU_METRICS = {
    "cpu_util": "cpu_util_pct", "mem_rss_kb": "mem_rss_kb", "mem_avail_kb": "mem_avail_kb",
    "mem_pct_util": "mem_pct_utilization", "read_kb": "read_kb", "write_kb": "write_kb",
}
QUANTILES = {"p25": 0.25, "p75": 0.75, "p95": 0.95}
GPU_QUANTILED = ("gpu_util", "gpu_mem_util")
CPU_QUANTILED = ("cpu_util", "mem_rss_kb", "mem_pct_util")


def stat_columns(prefix: str, x: str) -> dict[str, str]:
    m2 = f"avg(pow({x} - mu_{x}, 2))"
    return {
        f"{prefix}_mean": f"avg({x})",
        f"{prefix}_max": f"max({x})",
        f"{prefix}_min": f"min({x})",
        f"{prefix}_std": f"stddev_samp({x})",
        f"{prefix}_skew": f"CASE WHEN max({x}) > min({x}) THEN avg(pow({x} - mu_{x}, 3)) / pow({m2}, 1.5) END",
        f"{prefix}_kurtosis": f"CASE WHEN max({x}) > min({x}) THEN avg(pow({x} - mu_{x}, 4)) / pow({m2}, 2) - 3 END",
        f"{prefix}_iof": f"CASE WHEN avg({x}) = 0 THEN 0 ELSE var_samp({x}) / avg({x}) END",
    }


def series_cte(source: str, keys: str, metrics: dict[str, str], quantiled=(), extra: dict[str, str] | None = None) -> str:
    """CTE `series`: one row per series with the statistics of every metric."""
    columns: dict[str, str] = {}
    for prefix, x in metrics.items():
        columns |= stat_columns(prefix, x)
        if prefix in quantiled:
            columns |= {f"{prefix}_{p}": f"quantile_cont({x}, {q})" for p, q in QUANTILES.items()}
    columns |= extra or {}
    means = ", ".join(f"avg({x}) OVER (PARTITION BY {keys}) AS mu_{x}" for x in metrics.values())
    body = ",\n    ".join(f"{sql} AS {name}" for name, sql in columns.items())
    centred = f"(SELECT *, {means} FROM {source})" if means else source
    return f"series AS (\n  SELECT {keys},\n    {body}\n  FROM {centred} c GROUP BY {keys})"


def above(x: str, threshold: float) -> str:
    return f"count(*) FILTER (WHERE {x} > {threshold}) / nullif(CAST(count({x}) AS DOUBLE), 0)"


def names(metrics, quantiled=()) -> list[str]:
    return [f"{p}_{s}" for p in metrics for s in STATS + (tuple(QUANTILES) if p in quantiled else ())]


GPU_KEYS, CPU_KEYS = "job_id, node_id, gpu_index", "job_id, node_id"
ACTIVE = "gpu_util_mean > 50"
GPU_EXTRA = {
    "gpu_time_above_threshold_pct": above("util_pct", 50),
    "first_ts": "min(ts)",
    "busy_ts": "min(CASE WHEN util_pct > 50 THEN ts END)",
}
CPU_EXTRA = {
    "cpu_time_above_50pct": above("cpu_util_pct", 50),
    "mem_util_time_above_90pct": above("mem_pct_utilization", 0.9),
    "s_read": "sum(read_kb)", "s_write": "sum(write_kb)", "peak": "max(mem_rss_kb)",
    "s_avail": "sum(mem_avail_kb)", "n_avail": "count(mem_avail_kb)",
}
GPU_SERIES = series_cte("gpu_ts", GPU_KEYS, GPU_METRICS, GPU_QUANTILED, GPU_EXTRA)
CPU_SERIES = series_cte("cpu_ts", CPU_KEYS, CPU_METRICS, CPU_QUANTILED, CPU_EXTRA)


def active_avg(column: str) -> str:
    return f"avg(CASE WHEN {ACTIVE} THEN {column} END)"


def active_sum(column: str) -> str:
    some = f"count(*) FILTER (WHERE {ACTIVE}) > 0"
    return f"CASE WHEN {some} THEN coalesce(sum(CASE WHEN {ACTIVE} THEN {column} END), 0) END"


POWER = {
    "gpu_power_mean_total_w": active_sum("gpu_power_mean"),
    "gpu_power_peak_w": active_sum("gpu_power_max"),
    "gpu_power_mean_total_including_idle_w": "coalesce(sum(gpu_power_mean), 0)",
}
VARIABILITY = {
    "gpu_power_std_w": active_avg("gpu_power_std"), "gpu_power_skew": active_avg("gpu_power_skew"),
    "gpu_power_kurtosis": active_avg("gpu_power_kurtosis"), "gpu_power_min_w": active_avg("gpu_power_min"),
}
FIRST_USE = {
    "time_to_gpu_use_s": "CAST(epoch(min(busy_ts)) - epoch(min(first_ts)) AS DOUBLE)",
    "minutes_to_gpu_use": "CAST(epoch(min(busy_ts)) - epoch(min(first_ts)) AS DOUBLE) / 60",
}
IO = {"read_kb_total": "coalesce(sum(s_read), 0)", "write_kb_total": "coalesce(sum(s_write), 0)"}
PRESSURE = {
    "mem_pressure": "CASE WHEN sum(s_avail) / nullif(sum(n_avail), 0) > 0 "
    "THEN max(peak) / (sum(s_avail) / sum(n_avail)) END"
}


def by_job(columns: dict[str, str]) -> str:
    return "SELECT job_id, " + ",\n  ".join(r(sql, name) for name, sql in columns.items()) + " FROM series GROUP BY job_id"


def gpu_by_job(columns: dict[str, str]) -> str:
    return with_(GPU_TS, GPU_SERIES) + by_job(columns)


def cpu_by_job(columns: dict[str, str]) -> str:
    return with_(CPU_TS, CPU_SERIES) + by_job(columns)


# Imbalance

GPU_RI = {"gpu_util": "util_pct", "gpu_mem_util": "mem_util_pct", "gpu_mem_used": "mem_used_kib", "gpu_power": "power_w", "gpu_temp": "temperature"}
CPU_RI = {"cpu_util": "cpu_util_pct", "mem_rss": "mem_rss_kb", "mem_avail": "mem_avail_kb", "mem_pct_util": "mem_pct_utilization", "read_kb": "read_kb", "write_kb": "write_kb"}
GPU_SIGNAL = (
    "gpu_signal AS (SELECT job_id, node_id, ts, "
    + ", ".join(f"avg({c}) AS {c}" for c in GPU_RI.values())
    + " FROM gpu_ts GROUP BY job_id, node_id, ts)"
)


def imbalance_ctes(label: str, source: str, metrics: dict[str, str]) -> list[str]:
    """Peaks per node, then both imbalance values per job as CTE `ri_<label>`."""
    peaks = ", ".join(f"max({c}) AS mx_{m}, sum({c}) AS s_{m}, count({c}) AS n_{m}" for m, c in metrics.items())
    values = []
    for m in metrics:
        share = f"CASE WHEN mx_{m} IS NULL OR mx_{m} = 0 THEN 0 ELSE 1 - s_{m} / (mx_{m} * n_{m}) END"
        top = f"max(coalesce(mx_{m}, 0))"
        values.append(f"least(1, greatest(0, max(greatest(0, {share})))) AS ri_temporal_{m}")
        values.append(
            f"CASE WHEN count(*) <= 1 OR {top} = 0 THEN 0 ELSE least(1, greatest(0, "
            f"({top} * count(*) - sum(coalesce(mx_{m}, 0))) / ({top} * count(*)))) END AS ri_spatial_{m}"
        )
    return [
        f"peaks_{label} AS (SELECT job_id, node_id, {peaks} FROM {source} GROUP BY job_id, node_id)",
        f"ri_{label} AS (SELECT job_id, " + ", ".join(values) + f" FROM peaks_{label} GROUP BY job_id)",
    ]


def ri_names(metrics) -> list[str]:
    return [f"ri_{kind}_{m}" for m in metrics for kind in ("temporal", "spatial")]


# The wide row

CPU_WIDE = {n: f"avg({n})" for n in names(CPU_METRICS, CPU_QUANTILED) + ["cpu_time_above_50pct", "mem_util_time_above_90pct"]}
CPU_WIDE |= PRESSURE | IO
GPU_AVERAGED = [n for n in names(GPU_METRICS, GPU_QUANTILED) if not n.startswith("gpu_power_")] + ["gpu_time_above_threshold_pct"]
GPU_WIDE = {n: active_avg(n) for n in GPU_AVERAGED}
GPU_WIDE |= {"gpu_mem_used_kib_sum": active_sum("gpu_mem_used_kib_mean")} | POWER | VARIABILITY | FIRST_USE


def renamed(cte: str, name: str) -> str:
    return cte.replace("series AS (", f"{name} AS (", 1)


def _wide() -> str:
    cpu_part = ", ".join(f"{sql} AS {n}" for n, sql in CPU_WIDE.items())
    gpu_part = ", ".join(f"{sql} AS {n}" for n, sql in GPU_WIDE.items())
    is_gpu = "job_id IN (SELECT l_suppkey FROM lineitem)"
    gpu_names = list(GPU_WIDE)
    select = [
        "job_id", f"{is_gpu} AS is_gpu_job", "start_s AS start_timestamp", "end_s AS end_timestamp", "runtime_seconds",
        r("node_hours", "node_hours"), r("gpu_hours", "gpu_hours"), r("num_nodes", "num_nodes"), "num_alloc_gpus", "gpu_type", "user_id",
        "queue_name", "exit_code", r("cpus_req", "cpus_req"), "CAST(NULL AS VARCHAR) AS project_id",
        "CAST(NULL AS VARCHAR) AS domain", "CAST(NULL AS VARCHAR) AS subdomain",
        *[r(n, n) for n in CPU_WIDE], "num_gpus_used", "num_gpus_total_in_logs",
        r("CASE WHEN num_alloc_gpus > 0 THEN 1 - num_gpus_used / CAST(num_alloc_gpus AS DOUBLE) END", "gpu_idle_allocated_ratio"),
        *[r(n, n) for n in gpu_names],
        r("gpu_power_mean_total_w * runtime_seconds / 3600.0::DOUBLE", "gpu_energy_total_wh"),
        r("gpu_power_mean_total_including_idle_w * runtime_seconds / 3600.0::DOUBLE", "gpu_energy_total_including_idle_wh"),
        *[r(n, n) for n in ri_names(GPU_RI) + ri_names(CPU_RI)],
    ]
    return (
        with_(
            GPU_TS, CPU_TS, JOBS, renamed(GPU_SERIES, "gpu_series"), renamed(CPU_SERIES, "cpu_series"), GPU_SIGNAL,
            *imbalance_ctes("gpu", "gpu_signal", GPU_RI), *imbalance_ctes("cpu", "cpu_ts", CPU_RI),
            f"cpu_job AS (SELECT job_id, {cpu_part} FROM cpu_series GROUP BY job_id)",
            f"gpu_job AS (SELECT job_id, count(*) FILTER (WHERE {ACTIVE}) AS num_gpus_used, "
            f"count(*) AS num_gpus_total_in_logs, {gpu_part} FROM gpu_series GROUP BY job_id)",
        )
        + "SELECT " + ",\n  ".join(select)
        + "\nFROM jobs LEFT JOIN cpu_job USING (job_id) LEFT JOIN gpu_job USING (job_id)"
        " LEFT JOIN ri_gpu USING (job_id) LEFT JOIN ri_cpu USING (job_id)\n"
        "WHERE runtime_seconds > 10 AND (job_id IN (SELECT l_suppkey FROM lineitem) OR job_id IN (SELECT user_id FROM events))"
    )


ORACLES: dict[str, str] = {
    "gpu_series_stats": with_(GPU_TS, series_cte("gpu_ts", GPU_KEYS, GPU_METRICS))
    + f"SELECT {GPU_KEYS}, " + ", ".join(r(n, n) for n in names(GPU_METRICS)) + " FROM series",
    "gpu_job_stats": gpu_by_job({n: active_avg(n) for n in names(GPU_METRICS)}),
    "gpu_percentiles": gpu_by_job({f"{m}_{p}": active_avg(f"{m}_{p}") for m in GPU_QUANTILED for p in QUANTILES}),
    "gpu_time_above": gpu_by_job({"gpu_time_above_threshold_pct": active_avg("gpu_time_above_threshold_pct")}),
    "gpu_active_counts": with_(GPU_TS, GPU_SERIES, JOBS)
    + f"""SELECT job_id, num_gpus_used, num_gpus_total_in_logs,
  {r("CASE WHEN num_alloc_gpus > 0 THEN 1 - num_gpus_used / CAST(num_alloc_gpus AS DOUBLE) END", "gpu_idle_allocated_ratio")}
FROM (SELECT job_id, count(*) FILTER (WHERE {ACTIVE}) AS num_gpus_used, count(*) AS num_gpus_total_in_logs
      FROM series GROUP BY job_id) g JOIN jobs USING (job_id)""",
    "gpu_active_semijoin": with_(GPU_TS)
    + f"""SELECT job_id, count(*) AS samples, {r("avg(util_pct)", "util_mean")}, {r("max(power_w)", "power_max")}
FROM gpu_ts t WHERE (SELECT avg(util_pct) FROM gpu_ts a WHERE a.job_id = t.job_id AND a.node_id = t.node_id
                       AND a.gpu_index = t.gpu_index) > 50
GROUP BY job_id""",
    "gpu_power_energy": with_(GPU_TS, GPU_SERIES, JOBS, "power AS (SELECT job_id, " + ", ".join(f"{s} AS {n}" for n, s in POWER.items()) + " FROM series GROUP BY job_id)")
    + "SELECT job_id, " + ", ".join(r(n, n) for n in POWER)
    + ", " + r("gpu_power_mean_total_w * runtime_seconds / 3600.0::DOUBLE", "gpu_energy_total_wh")
    + ", " + r("gpu_power_mean_total_including_idle_w * runtime_seconds / 3600.0::DOUBLE", "gpu_energy_total_including_idle_wh")
    + " FROM power JOIN jobs USING (job_id)",
    "gpu_power_variability": gpu_by_job(VARIABILITY),
    "gpu_mem_totals": gpu_by_job({"gpu_mem_used_kib_sum": active_sum("gpu_mem_used_kib_mean"), "gpu_mem_used_kib_mean": active_avg("gpu_mem_used_kib_mean")}),
    "gpu_time_to_first_use": gpu_by_job(FIRST_USE),
    "gpu_node_signal": with_(GPU_TS, GPU_SIGNAL)
    + "SELECT job_id, node_id, CAST(epoch(ts) AS BIGINT) AS ts_s, " + ", ".join(r(c, c) for c in GPU_RI.values()) + " FROM gpu_signal",
    "ri_gpu": with_(GPU_TS, GPU_SIGNAL, *imbalance_ctes("gpu", "gpu_signal", GPU_RI))
    + "SELECT job_id, " + ", ".join(r(n, n) for n in ri_names(GPU_RI)) + " FROM ri_gpu",
    "cpu_job_stats": cpu_by_job({n: f"avg({n})" for n in names(CPU_METRICS)}),
    "cpu_percentiles": cpu_by_job({f"{m}_{p}": f"avg({m}_{p})" for m in CPU_QUANTILED for p in QUANTILES}),
    "cpu_time_above": cpu_by_job({n: f"avg({n})" for n in ("cpu_time_above_50pct", "mem_util_time_above_90pct")}),
    "cpu_normalised_util": with_(CPU_TS, JOBS)
    + f"""SELECT job_id, {r("avg(m)", "cpu_util_mean")}, {r("avg(x)", "cpu_util_max")}, {r("avg(a)", "cpu_time_above_50pct")}
FROM (SELECT job_id, node_id, avg(u) AS m, max(u) AS x, {above("u", 50)} AS a
      FROM (SELECT c.job_id, node_id, CASE WHEN cpus_per_node > 0 THEN cpu_util_pct * 4 / cpus_per_node
                                           ELSE cpu_util_pct * 4 END AS u
            FROM cpu_ts c JOIN jobs j ON c.job_id = j.job_id) s
      GROUP BY job_id, node_id) n GROUP BY job_id""",
    "cpu_io_totals": cpu_by_job(IO),
    "cpu_mem_pressure": cpu_by_job(PRESSURE),
    "cpu_mem_ratio": with_(CPU_TS)
    + f"""SELECT job_id, node_id, count(mem_pct_utilization) AS n, {r("min(mem_pct_utilization)", "lo")},
  {r("max(mem_pct_utilization)", "hi")} FROM cpu_ts GROUP BY job_id, node_id""",
    "ri_cpu": with_(CPU_TS, *imbalance_ctes("cpu", "cpu_ts", CPU_RI))
    + "SELECT job_id, " + ", ".join(r(n, n) for n in ri_names(CPU_RI)) + " FROM ri_cpu",
    "job_metadata": with_(JOBS)
    + f"""SELECT job_id, start_s, end_s, runtime_seconds, {r("node_hours", "node_hours")}, {r("gpu_hours", "gpu_hours")},
  {r("num_nodes", "num_nodes")}, num_alloc_gpus, gpu_type, user_id, queue_name, exit_code, {r("cpus_req", "cpus_req")},
  CAST(NULL AS VARCHAR) AS project_id, CAST(NULL AS VARCHAR) AS domain, CAST(NULL AS VARCHAR) AS subdomain,
  {r("cpus_per_node", "cpus_per_node")} FROM jobs""",
    "tres_parse": """WITH t AS (SELECT o_orderkey AS job_id, CASE o_orderkey % 7
    WHEN 0 THEN concat('cpu=8,mem=16G,100', o_orderkey % 4, '=', o_orderkey % 5)
    WHEN 1 THEN concat('1002=', o_orderkey % 7, 'G')
    WHEN 2 THEN concat('1002=', o_orderkey % 7, ',billing=', o_orderkey % 3)
    WHEN 3 THEN concat('1001=2,1002=', o_orderkey % 7, '.0')
    WHEN 5 THEN '1001'
    WHEN 6 THEN concat('1001= ', o_orderkey % 7, ' ') END AS tres FROM orders)
SELECT job_id,
  CAST(CASE WHEN regexp_matches(tres, '100[12]=')
            THEN coalesce(TRY_CAST(regexp_extract(tres, '=\\s*([+-]?[0-9]+)\\s*$', 1) AS INTEGER), 0) ELSE 0 END AS INTEGER) AS num_alloc_gpus,
  CASE WHEN contains(tres, '1001=') THEN 'tesla' WHEN contains(tres, '1002=') THEN 'volta' END AS gpu_type
FROM t""",
    "skip_short_jobs": with_(JOBS) + "SELECT job_id, runtime_seconds FROM jobs WHERE runtime_seconds > 10",
    "job_summary_wide": _wide(),
    "lenient_cast": f"""SELECT event_id, {r("CASE WHEN event_id % 10 IN (0, 1, 7) THEN value WHEN event_id % 10 = 9 THEN CAST(concat(value, 'e1') AS DOUBLE) END", "number")} FROM events""",
    "accounting_step_filter": """SELECT user_id, count(*) AS samples, count(step) AS with_step FROM (
  SELECT user_id, CASE event_id % 7 WHEN 0 THEN '-4' WHEN 1 THEN '-1' WHEN 2 THEN '0' WHEN 3 THEN 'batch'
                       WHEN 5 THEN '-1.0' WHEN 6 THEN '14' END AS step FROM events) e
WHERE step IS NULL OR step NOT IN ('-4', '-1', '-1.0') GROUP BY user_id""",
    "node_from_path": """SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'r62-n83' WHEN 2 THEN 'node1' ELSE '' END AS node_id,
  s_suppkey % 4 <> 1 AS valid FROM supplier""",
    "local_clock_to_utc": """WITH s AS (
  SELECT o_custkey AS job_id, o_orderkey, o_orderdate,
         first_value(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS first_wall FROM orders)
SELECT job_id, o_orderkey, CAST(epoch(o_orderdate) AS BIGINT)
  + CAST(epoch(first_wall AT TIME ZONE 'America/New_York') AS BIGINT) - CAST(epoch(first_wall) AS BIGINT) AS utc_s FROM s""",
    "sample_offset": """SELECT event_id, CAST(epoch(w) AS BIGINT) - CAST(epoch(w AT TIME ZONE 'America/New_York') AS BIGINT) AS offset_s
FROM (SELECT event_id, date_trunc('second', ts) AS w FROM events) e""",
    "gpu_log_samples": f"""WITH s AS (
  SELECT *, CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS BIGINT) AS gpu_index,
         first_value(l_shipdate) OVER (PARTITION BY l_suppkey, l_linenumber, l_returnflag
           ORDER BY l_orderkey * 100000 + l_partkey) AS first_wall
  FROM lineitem WHERE l_partkey % 50 <> 0)
SELECT l_suppkey AS job_id, concat('r', l_linenumber) AS node_id, gpu_index, count(*) AS samples,
  {r("sum(l_quantity * 2)", "util_sum")}, {r("sum(round(l_discount * 1000))", "mem_util_sum")},
  {r("sum(floor(l_extendedprice) * 1024)", "mem_used_kib_sum")},
  count(*) FILTER (WHERE l_partkey % 30 <> 0) AS power_n,
  {r("sum(CASE WHEN l_partkey % 30 <> 0 THEN 80 + l_quantity * 4 END)", "power_sum")},
  {r("sum(round(30 + l_tax * 500))", "temperature_sum")},
  CAST(sum(CAST(epoch(l_shipdate) AS BIGINT) + CAST(epoch(first_wall AT TIME ZONE 'America/New_York') AS BIGINT)
           - CAST(epoch(first_wall) AS BIGINT) - 800000000) AS BIGINT) AS ts_sum,
  true AS file_ok
FROM s GROUP BY ALL""",
    "cpu_log_samples": with_(JOBS)
    + f"""SELECT job_id, node_id, count(*) AS samples, {r("max(CASE WHEN cpus_per_node > 0 THEN floor(value) / cpus_per_node ELSE floor(value) END)", "util_max")},
  {r("sum(floor(value) * 10)", "rss_sum")}, count(*) FILTER (WHERE k > 0) AS ratio_n,
  {r("max(CASE WHEN k > 0 THEN floor(value) * 10 / k END)", "ratio_max")}, {r("sum(k * 1024)", "read_kb_total")},
  {r("sum(CAST(event_id % 100 AS DOUBLE) * 1024)", "write_kb_total")}, CAST(min(floor(epoch(ts))) AS BIGINT) AS first_s
FROM (SELECT *, user_id AS job_id, CASE WHEN event_id % 13 <> 0 THEN event_type END AS node_id,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) e JOIN jobs USING (job_id)
WHERE event_type <> 'signup' AND event_id % 17 <> 0
GROUP BY job_id, node_id""",
    "file_index_explode": """SELECT job_id, 'cpu' AS kind, 0 AS pos, concat('cpu/', job_id, '-timeseries.csv') AS path,
  'timeseries' AS node_id, true AS names_node FROM (SELECT DISTINCT user_id AS job_id FROM events) u
UNION ALL
SELECT job_id, 'gpu', CAST(row_number() OVER (PARTITION BY job_id ORDER BY line) - 1 AS INTEGER),
  concat('gpu/', job_id, '-r', line, '.csv'), concat('r', line), true
FROM (SELECT DISTINCT l_suppkey AS job_id, l_linenumber AS line FROM lineitem) l""",
    "file_index_counts": """SELECT (SELECT count(*) FROM (SELECT user_id FROM events UNION SELECT l_suppkey FROM lineitem) j) AS jobs,
  (SELECT count(DISTINCT user_id) FROM events) AS jobs_with_cpu, (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS jobs_with_gpu""",
    "pending_jobs": with_(JOBS)
    + """SELECT job_id, runtime_seconds FROM jobs
WHERE job_id IN (SELECT l_orderkey FROM lineitem) AND o_orderstatus <> 'F'""",
    "run_accounting": """SELECT count(*) AS total, count(*) FILTER (WHERE n IS NOT NULL AND o_orderstatus <> 'F') AS to_process,
  count(*) FILTER (WHERE n IS NULL) AS no_files, count(*) FILTER (WHERE n IS NOT NULL AND o_orderstatus = 'F') AS already_done
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey""",
    "run_plan": """SELECT count(*) FILTER (WHERE o_orderstatus <> 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS to_process,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS already_done, 500 AS batch_size,
  CAST(ceil(count(*) FILTER (WHERE o_orderstatus <> 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)) / 500.0) AS BIGINT) AS batches,
  3 AS existing_runs FROM orders""",
    "job_batches": """SELECT o_orderkey AS job_id, CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 500 AS BIGINT) AS batch
FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    "jobs_in_order": """SELECT o_orderkey AS job_id, CAST(epoch(o_orderdate) AS BIGINT) AS submit_s FROM orders
WHERE o_orderstatus <> 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem) ORDER BY submit_s, job_id""",
    "union_chunks": with_(JOBS)
    + f"""SELECT job_id, runtime_seconds, {r("CASE WHEN o_orderstatus = 'F' THEN num_nodes END", "num_nodes")},
  CASE WHEN o_orderstatus <> 'F' THEN queue_name END AS queue_name FROM jobs""",
    "ledger_repair": with_(JOBS) + "SELECT job_id FROM jobs WHERE runtime_seconds > 10 AND o_orderstatus = 'P'",
    "done_set": with_(JOBS) + "SELECT job_id FROM jobs WHERE runtime_seconds > 10 OR o_orderstatus = 'F'",
    "ledger_states": with_(JOBS)
    + """SELECT status, count(*) AS jobs, CAST(sum(found) AS BIGINT) AS logs_found FROM (
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'failed' WHEN runtime_seconds <= 10 THEN 'skipped'
    WHEN job_id % 7 = 0 AND logs > 0 THEN 'missing_logs' ELSE 'done' END AS status,
    CASE WHEN o_orderstatus <> 'P' AND runtime_seconds > 10 AND job_id % 7 = 0 AND logs > 0
      THEN logs - 1 + (SELECT count(*) FROM (SELECT DISTINCT user_id FROM events) u WHERE u.user_id = job_id) END AS found
  FROM jobs LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_linenumber) AS logs FROM lineitem GROUP BY 1) l ON l_suppkey = job_id)
GROUP BY ALL""",
    "scheduler_two_orders": """SELECT CAST(o_orderkey AS VARCHAR) AS id_job, CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS time_submit,
  CASE WHEN o_orderkey % 89 <> 0 THEN CAST(nodes AS VARCHAR) END AS nodes_alloc, concat('cpu=8,mem=16G,100', o_orderkey % 4, '=', o_orderkey % 5) AS tres_alloc,
  CASE WHEN o_orderstatus <> 'P' THEN concat(' ', o_orderpriority, ' ') END AS "partition", CAST(o_custkey AS VARCHAR) AS id_user
FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_suppkey) AS nodes FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey""",
}

# The same logs, read from files.
ORACLES["gpu_log_files"] = ORACLES["gpu_log_samples"]
ORACLES["cpu_log_files"] = ORACLES["cpu_log_samples"]

# Overview reports


def report(sql: str) -> str:
    return with_(JOBS, OVERVIEW) + sql


COUNTED = 'count(*) AS "count"'


def binned(source: str, value: str, bins: int) -> str:
    """Equal-width bins whose computed edges enclose the values; the last bin is closed."""
    return f"""v AS (SELECT {value} AS x FROM {source} WHERE {value} IS NOT NULL),
e AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             (CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END
              - CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END) / {bins} AS step FROM v),
b AS (SELECT CAST(i AS INTEGER) AS bin, lo + i * step AS lower, lo + (i + 1) * step AS upper
      FROM range({bins}) t(i), e)
SELECT bin, {r("lower", "lower")}, {r("upper", "upper")},
  (SELECT count(*) FROM v WHERE x >= b.lower AND (x < b.upper OR b.bin = {bins - 1})) AS "count"
FROM b"""


def cdf(source: str, value: str, by: str = "") -> str:
    """Distinct values with their counts, running counts and group sizes as CTE `c`."""
    keys = f"{by}, {value}" if by else value
    part = f"PARTITION BY {by}" if by else ""
    return f"""c AS (SELECT {keys}, count(*) AS n, sum(count(*)) OVER ({part} ORDER BY {value}) AS upto,
  sum(count(*)) OVER ({part}) AS total FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys})"""


LOG_HOURS = "h AS (SELECT log10(greatest(runtime_hours, 1e-3)) AS log_hours FROM ov WHERE runtime_hours > 0)"

ORACLES |= {
    "job_overview": report(
        f"""SELECT job_id, month, day_of_week, strftime(date, '%Y-%m-%d') AS date, partition, is_gpu_job,
  {r("runtime_hours", "runtime_hours")}, is_success, {r("num_nodes", "num_nodes")}, {r("node_hours", "node_hours")},
  {r("gpu_hours", "gpu_hours")} FROM ov"""
    ),
    "busiest_days_top10": report(f"SELECT strftime(date, '%Y-%m-%d') AS date, {COUNTED} FROM ov GROUP BY date ORDER BY 2 DESC, 1 LIMIT 10"),
    "jobs_by_month": report(f"SELECT month, {COUNTED} FROM ov GROUP BY month"),
    "jobs_by_weekday": report(
        """SELECT CAST(i AS INTEGER) AS day_of_week, ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][i + 1] AS label,
  (SELECT count(*) FROM ov WHERE day_of_week = i) AS "count" FROM range(7) t(i)"""
    ),
    "nodes_stats": report(
        f"""SELECT count(*) AS total, {r("avg(CASE WHEN num_nodes = 1 THEN 1.0 ELSE 0.0 END) * 100", "one_node_pct")},
  {r("quantile_cont(num_nodes, 0.5)", "median")}, {r("quantile_cont(num_nodes, 0.9)", "p90")}, {r("quantile_cont(num_nodes, 0.99)", "p99")} FROM ov"""
    ),
    "nodes_histogram": with_(JOBS, OVERVIEW, binned("ov", "num_nodes", 50)),
    "nodes_cdf": with_(JOBS, OVERVIEW, cdf("ov", "num_nodes"))
    + f"""SELECT {r("num_nodes", "num_nodes")}, n AS "count", {r("(upto - n) / CAST(everyone AS DOUBLE)", "cdf_first")},
  {r("(upto - 1) / CAST(everyone AS DOUBLE)", "cdf_last")} FROM c, (SELECT count(*) AS everyone FROM ov) t""",
    "nodes_capped": with_(
        JOBS, OVERVIEW,
        """q AS (SELECT CAST(trunc(quantile_cont(num_nodes, 0.99)) AS BIGINT) + 1 AS cap, quantile_cont(num_nodes, 0.5) AS p50,
  quantile_cont(num_nodes, 0.95) AS p95 FROM ov WHERE num_nodes > 0)""",
        "u AS (SELECT num_nodes FROM ov, q WHERE num_nodes > 0 AND num_nodes <= cap)", cdf("u", "num_nodes"),
    )
    + f"""SELECT {r("num_nodes", "num_nodes")}, n AS "count", {r("upto / CAST(total AS DOUBLE)", "cdf")}, cap, {r("p50", "p50")}, {r("p95", "p95")}
FROM c, q""",
    "job_type_split": report(f"SELECT is_gpu_job, {COUNTED}, {r('count(*) * 100.0 / (SELECT count(*) FROM ov)', 'pct')} FROM ov GROUP BY is_gpu_job"),
    "job_type_by_month": report("SELECT month, count(*) FILTER (WHERE NOT is_gpu_job) AS cpu, count(*) FILTER (WHERE is_gpu_job) AS gpu FROM ov GROUP BY month"),
    "error_rate_by_month": report(
        f"""SELECT month, count(*) AS total, count(*) FILTER (WHERE is_success) AS success,
  count(*) FILTER (WHERE NOT is_success) AS errors, {r("count(*) FILTER (WHERE NOT is_success) * 100.0::DOUBLE / count(*)", "error_rate")}
FROM ov GROUP BY month"""
    ),
    "duration_histogram": with_(JOBS, OVERVIEW, LOG_HOURS, binned("h", "log_hours", 80)),
    "duration_cdf": with_(JOBS, OVERVIEW, LOG_HOURS, cdf("h", "log_hours"))
    + f"""SELECT {r("log_hours", "log_hours")}, n AS "count", {r("upto / CAST(total AS DOUBLE)", "cdf")} FROM c""",
    "duration_quantiles": report(
        f"""SELECT {r("quantile_cont(runtime_hours, 0.5)", "p50")}, {r("quantile_cont(runtime_hours, 0.95)", "p95")}
FROM ov WHERE runtime_hours > 0"""
    ),
    "daily_throughput": with_(JOBS, OVERVIEW, f"d AS (SELECT date, {COUNTED} FROM ov GROUP BY date)")
    + f"""SELECT strftime(date, '%Y-%m-%d') AS date, "count",
  {r('CASE WHEN count(*) OVER w = 7 THEN avg("count") OVER w END', "rolling7")}, isodow(date) >= 6 AS is_weekend
FROM d WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
    "busiest_days": report(f"SELECT strftime(date, '%Y-%m-%d') AS date, {COUNTED} FROM ov GROUP BY date"),
    "jobs_by_partition": report(f"SELECT partition, {COUNTED} FROM ov GROUP BY partition"),
    "gpu_hours_by_partition": report(f"SELECT partition, {r('coalesce(sum(gpu_hours), 0)', 'gpu_hours')} FROM ov GROUP BY partition"),
    "gpu_pct_by_partition": report(f"SELECT partition, {r('avg(CASE WHEN is_gpu_job THEN 1.0 ELSE 0.0 END) * 100', 'gpu_pct')} FROM ov GROUP BY partition"),
    "resource_hours_by_month": report(
        f"SELECT month, {r('coalesce(sum(node_hours), 0)', 'node_hours')}, {r('coalesce(sum(gpu_hours), 0)', 'gpu_hours')} FROM ov GROUP BY month"
    ),
    "runtime_hist_by_type": with_(
        JOBS, OVERVIEW, "p AS (SELECT is_gpu_job, runtime_hours AS x FROM ov WHERE runtime_hours >= 1e-3)",
        "e AS (SELECT (log10(max(x) + 1) - log10(1e-3)) / 59 AS step FROM p)",
        """b AS (SELECT CAST(i AS INTEGER) AS bin, pow(10, log10(1e-3) + i * step) AS lower, pow(10, log10(1e-3) + (i + 1) * step) AS upper
  FROM range(59) t(i), e)""",
        "n AS (SELECT is_gpu_job, count(*) AS total FROM p GROUP BY is_gpu_job)",
    )
    + f"""SELECT n.is_gpu_job, bin, {r("lower", "lower")}, {r("upper", "upper")}, count(x) AS "count",
  {r("count(x) / (total * (upper - lower))", "density")}
FROM n CROSS JOIN b LEFT JOIN p ON p.is_gpu_job = n.is_gpu_job AND x >= lower AND (x < upper OR bin = 58)
GROUP BY n.is_gpu_job, bin, lower, upper, total""",
    "runtime_cdf_by_type": with_(JOBS, OVERVIEW, "p AS (SELECT * FROM ov WHERE runtime_hours > 0)", cdf("p", "runtime_hours", "is_gpu_job"))
    + f"""SELECT is_gpu_job, {r("runtime_hours", "runtime_hours")}, n AS "count", {r("upto / CAST(total AS DOUBLE)", "cdf")} FROM c""",
    "runtime_quantiles_by_type": report(
        f"""SELECT is_gpu_job, {r("quantile_cont(runtime_hours, 0.5)", "p50")}, {r("quantile_cont(runtime_hours, 0.95)", "p95")}
FROM ov WHERE runtime_hours > 0 GROUP BY is_gpu_job"""
    ),
}
