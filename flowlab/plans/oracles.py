"""For each query that SQL can express, the same result as one DuckDB statement."""

from __future__ import annotations

from flowlab.plans.inputs import CLASSED_SQL, FLOWS_SQL, SCORED_LIFTS, SCORED_SQL

# The rules are spelled out here once more: a wrong constant in the library must not pass.
SENTINELS = ["Infinity", "-Infinity", "inf", "-inf"]
MEASURES = [
    "duration",
    "fwd_packets_count",
    "bwd_packets_count",
    "fwd_total_payload_bytes",
    "bwd_total_payload_bytes",
    "bytes_rate",
    "packets_rate",
]
EXPLORED_HERE = ["duration", "fwd_packets_count", "bwd_packets_count", "bytes_rate", "packets_rate"]
CHECKED = [
    "duration",
    "bytes_rate",
    "packets_rate",
    "total_packets",
    "total_payload_bytes",
    "avg_payload_per_packet",
    "fwd_bwd_packet_ratio",
    "log_duration",
    "log_bytes_rate",
    "log_packets_rate",
]
METRICS = ["accuracy", "precision", "recall", "f1", "auc_roc"]
MODEL_LR = "Model A - Logistic Regression"
MODEL_MLP = "Model B - Deep Learning MLP"
MODEL_RF = "Model C - Random Forest"
TRAIN_PERCENT = 80
HISTOGRAM_BINS = 50
LOGS = {"log_duration": "duration", "log_bytes_rate": "bytes_rate", "log_packets_rate": "packets_rate"}
FEATURES = [
    *MEASURES,
    "total_packets",
    "total_payload_bytes",
    "fwd_bwd_packet_ratio",
    *LOGS,
    "avg_payload_per_packet",
]
BASELINE = next(iter(SCORED_LIFTS))

FLOWS = FLOWS_SQL.format(S="VARCHAR", lineitem="lineitem")
IN_LIST = ", ".join(f"'{s}'" for s in SENTINELS)


def percent_of(key: str) -> str:
    return f"('0x' || substr(md5(coalesce({key}, '')), 1, 8))::BIGINT % 100"


def in_train(key: str = "flow_id") -> str:
    return f"{percent_of(key)} < {TRAIN_PERCENT}"


def cast_of(name: str, strict: bool = False) -> str:
    value = f"CASE WHEN {name} IN ({IN_LIST}) THEN NULL ELSE TRY_CAST({name} AS DOUBLE) END"
    return f"CASE WHEN isfinite({value}) THEN {value} END" if strict else value


def typed(source: str = "flows", strict: bool = False) -> str:
    casts = ", ".join(f"{cast_of(m, strict)} AS {m}" for m in MEASURES)
    return f"SELECT flow_id, {casts}, label FROM {source}"


LABEL = "CASE WHEN contains(upper(label), 'WEB') THEN 'WEB_ATTACK' ELSE trim(upper(label)) END"


def cleaned(source: str = "typed", keep_nulls: bool = False) -> str:
    negative = " OR ".join(f"{m} < 0" for m in MEASURES)
    keep = f"NOT coalesce({negative}, FALSE)" if keep_nulls else f"NOT ({negative})"
    return f"SELECT flow_id, {', '.join(MEASURES)}, {LABEL} AS label FROM {source} WHERE {keep}"


WITH_FLOWS = f"WITH flows AS ({FLOWS})"
WITH_TYPED = f"{WITH_FLOWS}, typed AS ({typed()})"
WITH_STRICT = f"{WITH_FLOWS}, typed AS ({typed(strict=True)})"
WITH_CLEANED = f"{WITH_TYPED}, cleaned AS ({cleaned()})"


def no_nan(value: str) -> str:
    return f"CASE WHEN isnan({value}) THEN NULL ELSE {value} END"


# NaN counts as missing
WITH_PRESENT = (
    f"{WITH_TYPED}, present AS (SELECT flow_id, label, "
    + ", ".join(f"{no_nan(m)} AS {m}" for m in MEASURES)
    + " FROM typed)"
)

TARGET = "CASE WHEN label = 'BENIGN' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END"


def log_of(name: str) -> str:
    return f"ln(1 + CASE WHEN {name} >= 0 THEN {name} ELSE 0.0::DOUBLE END)"


RATIO = "CASE WHEN bwd_packets_count > 0 THEN fwd_packets_count / bwd_packets_count ELSE 0.0::DOUBLE END"
AVERAGE = "CASE WHEN total_packets > 0 THEN total_payload_bytes / total_packets ELSE 0.0::DOUBLE END"
WITH_DERIVED = (
    f"{WITH_CLEANED}, totals AS (SELECT *, fwd_packets_count + bwd_packets_count AS total_packets, "
    f"fwd_total_payload_bytes + bwd_total_payload_bytes AS total_payload_bytes, "
    f"{RATIO} AS fwd_bwd_packet_ratio, "
    + ", ".join(f"{log_of(c)} AS {n}" for n, c in LOGS.items())
    + f" FROM cleaned), derived AS (SELECT *, {AVERAGE} AS avg_payload_per_packet FROM totals)"
)
WITH_ENGINEERED = (
    f"{WITH_DERIVED}, engineered AS (SELECT flow_id, label AS label_original, {TARGET} AS label, "
    + ", ".join(f"{no_nan(f)} AS {f}" for f in FEATURES)
    + " FROM derived)"
)


def bounds(source: str, names: list[str]) -> str:
    parts = (
        f"quantile_disc({n}, 0.01) AS lo_{n}, quantile_disc({n}, 0.99) AS hi_{n}" for n in names
    )
    return f"SELECT {', '.join(parts)} FROM {source}"


def capped(name: str) -> str:
    inside = f"CASE WHEN {name} < lo_{name} THEN lo_{name} WHEN {name} > hi_{name} THEN hi_{name} ELSE {name} END"
    return f"CASE WHEN lo_{name} < hi_{name} THEN {inside} ELSE {name} END"


WITH_READY = (
    f"{WITH_ENGINEERED}, bounds AS ({bounds('engineered', FEATURES)}), ready AS (SELECT flow_id, label, label_original, "
    + ", ".join(f"coalesce({capped(f)}, 0.0) AS {f}" for f in FEATURES)
    + " FROM engineered, bounds)"
)
ROUNDED_LOGS = ", ".join(f"round({f}, 6) AS {f}" if f in LOGS else f for f in FEATURES)


def describe(source: str, names: list[str], digits: int, outer: int | None = None) -> str:
    def stats(n: str) -> list[tuple[str, str]]:
        return [
            ("count", f"count({n})::DOUBLE"),
            ("mean", f"round(avg({n}), {digits})"),
            ("stddev", f"round(stddev_samp({n}), {digits})"),
            ("min", f"min({n})::DOUBLE"),
            ("max", f"max({n})::DOUBLE"),
        ]

    rows = (
        f"SELECT '{n}' AS \"column\", '{s}' AS stat, {e if outer is None else f'round({e}, {outer})'} AS value FROM {source}"
        for n in names
        for s, e in stats(n)
    )
    return " UNION ALL ".join(rows)


def class_means(source: str, label: str, names: list[str]) -> str:
    spans = ", ".join(f"min({n}) AS lo_{n}, max({n}) AS hi_{n}" for n in names)
    means = ", ".join(
        f"round(avg(CASE WHEN hi_{n} > lo_{n} THEN ({n} - lo_{n}) / (hi_{n} - lo_{n}) ELSE 0.0 END), 6) AS {n}"
        for n in names
    )
    return f"SELECT {label}, {means} FROM {source}, (SELECT {spans} FROM {source}) GROUP BY {label}"


def histogram(source: str, names: list[str]) -> str:
    values = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, ln(1 + {n}) AS v FROM {source} WHERE {n} > 0" for n in names
    )
    place = (
        f"least(floor((v - lo) / (hi - lo) * {HISTOGRAM_BINS}), {HISTOGRAM_BINS - 1})::INTEGER"
    )
    return (
        f"vals AS ({values}), spans AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM vals GROUP BY feature), "
        f"placed AS (SELECT feature, CASE WHEN hi > lo THEN {place} ELSE {HISTOGRAM_BINS // 2} END AS bin "
        f"FROM vals JOIN spans USING (feature)), "
        f"slots AS (SELECT feature, bin::INTEGER AS bin FROM spans, range({HISTOGRAM_BINS}) r(bin)) "
        f"SELECT s.feature, s.bin, count(p.bin) AS count FROM slots s LEFT JOIN placed p "
        f"ON s.feature = p.feature AND s.bin = p.bin GROUP BY s.feature, s.bin"
    )


def share(source: str, label: str, digits: int, where: str = "TRUE") -> str:
    return (
        f"SELECT {label}, count(*) AS count, round(100 * count(*) / (sum(count(*)) OVER ()), {digits}) AS percent "
        f"FROM {source} WHERE {where} GROUP BY {label}"
    )


# ---- scored models

LIFTS = ", ".join(f"('{m}', {lift})" for m, lift in SCORED_LIFTS.items())
WITH_SCORED = "WITH scored AS ({})".format(
    SCORED_SQL.format(S="VARCHAR", lineitem="lineitem", models=f"CROSS JOIN (VALUES {LIFTS}) lifts(model, lift)")
)
WITH_CELLS = f"{WITH_SCORED}, cells AS (SELECT model, label, prediction, count(*) AS count FROM scored GROUP BY ALL)"
CLASS_STEPS = """, actual AS (SELECT model, label AS class, sum(count)::BIGINT AS rows,
    coalesce(sum(count) FILTER (label = prediction), 0)::BIGINT AS hits FROM cells GROUP BY ALL),
  predicted AS (SELECT model, prediction AS class, sum(count)::BIGINT AS n FROM cells GROUP BY ALL),
  pr AS (SELECT a.model, a.class, a.rows, a.hits, CASE WHEN n > 0 THEN hits / n ELSE 0.0::DOUBLE END AS precision,
    hits / rows AS recall FROM actual a LEFT JOIN predicted p ON a.model = p.model AND a.class = p.class),
  classes AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
    ELSE 0.0::DOUBLE END AS f1 FROM pr)"""
WITH_CLASSES = WITH_CELLS + CLASS_STEPS
WITH_RANKED = """{scored}, steps AS (SELECT model, score, count(*) FILTER (label > 0.5) AS p,
    count(*) FILTER (label <= 0.5) AS n FROM scored GROUP BY model, score),
  ranked AS (SELECT *, (sum(p) OVER w)::BIGINT AS tp, (sum(n) OVER w)::BIGINT AS fp,
    lead(p) OVER w AS p_next, lead(n) OVER w AS n_next, lag(p) OVER w AS p_before FROM steps
    WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
  sums AS (SELECT model, sum(p)::BIGINT AS positives, sum(n)::BIGINT AS negatives FROM steps GROUP BY model)"""
AREA = """SELECT model, sum(n * (2 * tp - p))::DOUBLE / (2.0::DOUBLE * max(positives) * max(negatives)) AS auc_roc
  FROM ranked JOIN sums USING (model) GROUP BY model"""
WITH_AREA = WITH_RANKED.format(scored=WITH_CLASSES) + f", area AS ({AREA})"
WITH_WIDE = f"""{WITH_AREA}, wide AS (SELECT model, sum(hits) / sum(rows) AS accuracy,
    sum(precision * rows) / sum(rows) AS precision, sum(hits) / sum(rows) AS recall, sum(f1 * rows) / sum(rows) AS f1,
    max(auc_roc) AS auc_roc FROM classes JOIN area USING (model) GROUP BY model)"""
WITH_LONG = f"{WITH_WIDE}, long AS (" + " UNION ALL ".join(
    f"SELECT model, '{m}' AS metric, {m} AS value FROM wide" for m in METRICS
) + ")"

# ---- several classes

CLASSES_KNOWN = 7
WITH_FOUND = f"""WITH classed AS ({CLASSED_SQL.format(S="VARCHAR", lineitem="lineitem")}),
  numbers AS (SELECT label_original AS class, (row_number() OVER (ORDER BY count(*) DESC, label_original) - 1)::DOUBLE AS place
    FROM classed WHERE label_original <> 'Other' GROUP BY label_original
    UNION ALL SELECT '(unseen)', {CLASSES_KNOWN}.0::DOUBLE),
  found AS (SELECT label, (label + shift) % {CLASSES_KNOWN} AS prediction, base
    FROM (SELECT coalesce(place, {CLASSES_KNOWN}.0::DOUBLE) AS label, shift, base FROM classed
          LEFT JOIN numbers ON class = label_original))"""
WITH_REPORT = WITH_RANKED.format(
    scored=f"""{WITH_FOUND}, cells AS (SELECT 'made up' AS model, label, prediction, count(*) AS count FROM found GROUP BY ALL)
  {CLASS_STEPS}, scored AS (SELECT place::DOUBLE AS model, CASE WHEN place = label THEN 1 ELSE 0 END AS label,
    (base + place * 131) % 1000 + CASE WHEN place = label THEN 300 ELSE 0 END AS score
    FROM found, range({CLASSES_KNOWN}) places(place))"""
) + f""", area AS ({AREA}), report AS (SELECT c.model, n.class, c.rows, c.hits, c.precision, c.recall, c.f1, area.auc_roc
    FROM classes c JOIN numbers n ON n.place = c.class LEFT JOIN area ON area.model = c.class)"""
FOLDS = 3
FOLD = f"(('0x' || substr(md5('fold:' || coalesce(flow_id, '')), 1, 8))::BIGINT % {FOLDS})::INTEGER"


def oracle_sql() -> dict[str, str]:
    wide = ", ".join(f"round({m}, 9) AS {m}" for m in METRICS)
    wide4 = ", ".join(f"round({m}, 4) AS {m}" for m in METRICS)
    count_nulls = " UNION ALL ".join(
        f"SELECT '{m}' AS \"column\", count(*) FILTER ({m} IS NULL) AS null_count FROM typed" for m in MEASURES
    )
    count_sentinels = " UNION ALL ".join(
        f"SELECT '{m}' AS \"column\", count(*) FILTER ({m} IN ({IN_LIST})) AS sentinel_count FROM flows"
        for m in MEASURES
    )
    quantile_rows = " UNION ALL ".join(
        f"SELECT '{m}' AS \"column\", {p}::DOUBLE AS probability, quantile_disc({m}, {p}) AS value FROM present"
        for m in MEASURES
        for p in (0.01, 0.99)
    )
    present = ", ".join(f"{no_nan(m)} AS {m}" for m in MEASURES)
    ranges = ", ".join(f"min({m}) AS lo_{m}, max({m}) AS hi_{m}" for m in EXPLORED_HERE)
    scaled = ", ".join(
        f"CASE WHEN hi_{m} > lo_{m} THEN ({m} - lo_{m}) / (hi_{m} - lo_{m}) ELSE 0.0 END AS {m}"
        for m in EXPLORED_HERE
    )
    deviations = ", ".join(f"stddev_samp({f}) AS sd_{f}" for f in FEATURES)
    unit = ", ".join(
        f"round(CASE WHEN sd_{f} > 0 THEN {f} / sd_{f} ELSE 0.0 END, 6) AS {f}" for f in FEATURES
    )
    stages = f"""SELECT 0 AS position, 'raw' AS stage, count(*) AS rows FROM flows
        UNION ALL SELECT 1, 'cleaned', count(*) FROM cleaned UNION ALL SELECT 2, 'ml_ready', count(*) FROM cleaned
        UNION ALL SELECT 3, 'test', count(*) FROM cleaned WHERE NOT ({in_train()})"""
    types = " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS position, '{c}' AS name, '{'double' if c in MEASURES else 'string'}' AS type, "
        f"count({c}) AS filled FROM typed"
        for i, c in enumerate(["flow_id", "duration", "fwd_packets_count", "bwd_packets_count",
                               "fwd_total_payload_bytes", "bwd_total_payload_bytes", "bytes_rate",
                               "packets_rate", "label"])
    )
    events = ["user_id", "value"]
    names = ", ".join(f"('{m}')" for m in (MODEL_LR, MODEL_MLP, MODEL_RF))
    clean_rows = f"{WITH_CLEANED} SELECT * FROM cleaned"
    distribution = f"{WITH_CLEANED} SELECT label, count(*) AS count FROM cleaned GROUP BY label"
    ready = f"{WITH_READY} SELECT flow_id, label, label_original, {ROUNDED_LOGS} FROM ready"
    return {
        "clean_label_distribution": f"{distribution} ORDER BY count DESC, label",
        "clean_rows": clean_rows,
        "clean_rows_keep_nulls": f"{WITH_TYPED} {cleaned(keep_nulls=True)}",
        "clean_rows_strict": f"{WITH_STRICT} {cleaned(keep_nulls=True)}",
        "clean_dedup": f"{WITH_FLOWS} SELECT DISTINCT * FROM (SELECT * FROM flows UNION ALL "
        "SELECT * FROM flows WHERE label = 'Heartbleed')",
        "cast_failures": f"{WITH_FLOWS} SELECT 'flow_id' AS \"column\", count(*) AS failed FROM flows "
        f"WHERE flow_id NOT IN ({IN_LIST}) AND TRY_CAST(flow_id AS DOUBLE) IS NULL",
        "row_count": f"{WITH_CLEANED} SELECT count(*) AS rows FROM cleaned",
        "null_profile": f"{WITH_TYPED} SELECT * FROM ({count_nulls}) WHERE null_count > 0 "
        "ORDER BY null_count DESC, \"column\" LIMIT 20",
        "sentinel_profile": f"{WITH_FLOWS} SELECT * FROM ({count_sentinels}) WHERE sentinel_count > 0",
        "describe_long": f"{WITH_STRICT} {describe('typed', EXPLORED_HERE, 6)}",
        "summary_long": f"{WITH_READY} {describe('ready', list(CHECKED), 4, outer=4)}",
        "binary_distribution": f"{WITH_CLEANED} SELECT {TARGET} AS label, count(*) AS count FROM cleaned GROUP BY 1",
        "class_share": f"{WITH_CLEANED} {share('cleaned', 'label', 2)}",
        "attack_share": f"{WITH_FLOWS} {share('flows', 'label', 1, where="upper(label) <> 'BENIGN'")}",
        "sampled_distribution": f"{WITH_FLOWS} SELECT label, count(*) AS sampled, "
        "(count(*) * 100 / 10)::BIGINT AS estimate FROM flows "
        f"WHERE {percent_of("'sample:' || flow_id")} < 10 GROUP BY label",
        "stage_reconciliation": f"{WITH_CLEANED}, stages AS ({stages}) SELECT position::INTEGER AS position, stage, rows, "
        "lag(rows) OVER w - rows AS removed, round(100 * (lag(rows) OVER w - rows) / lag(rows) OVER w, 4) "
        "AS removed_percent FROM stages WINDOW w AS (ORDER BY position)",
        "minmax_scaled": f"{WITH_PRESENT} SELECT flow_id, label, {scaled} FROM present, (SELECT {ranges} FROM present)",
        "minmax_label_means": f"{WITH_PRESENT} {class_means('present', 'label', EXPLORED_HERE)}",
        "log_values": f"{WITH_PRESENT} "
        + " UNION ALL ".join(
            f"SELECT '{m}' AS feature, count(*) AS rows, round(min(ln(1 + {m})), 6) AS low, "
            f"round(max(ln(1 + {m})), 6) AS high FROM present WHERE {m} > 0"
            for m in EXPLORED_HERE
        ),
        "log_histogram": f"{WITH_PRESENT}, {histogram('present', EXPLORED_HERE)}",
        "hash_split_counts": f"{WITH_FLOWS} SELECT CASE WHEN {in_train()} THEN 'train' ELSE 'test' END AS part, "
        "count(*) AS count FROM flows GROUP BY 1",
        "events_distribution": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
        "events_share": share("events", "event_type", 2, where="upper(event_type) <> 'ERROR'"),
        "events_describe": describe("events", events, 6),
        "events_minmax_means": class_means("events", "event_type", events),
        "events_histogram": f"WITH {histogram('events', events)}",
        "events_quantiles": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS probability, quantile_disc({c}, {p})::DOUBLE AS value FROM events"
            for c in events
            for p in (0.01, 0.5, 0.99)
        ),
        "feature_totals": f"{WITH_DERIVED} SELECT flow_id, total_packets, total_payload_bytes FROM derived",
        "feature_ratios": f"{WITH_DERIVED} SELECT flow_id, fwd_bwd_packet_ratio, avg_payload_per_packet FROM derived",
        "feature_logs": f"{WITH_DERIVED} SELECT flow_id, "
        + ", ".join(f"round({n}, 6) AS {n}" for n in LOGS)
        + " FROM derived",
        "quantile_bounds": f"{WITH_CLEANED}, present AS (SELECT {present} FROM cleaned) {quantile_rows}",
        "winsorized": f"{WITH_CLEANED}, present AS (SELECT flow_id, {present} FROM cleaned), "
        f"bounds AS ({bounds('present', MEASURES)}) SELECT flow_id, "
        + ", ".join(f"{capped(m)} AS {m}" for m in MEASURES)
        + " FROM present, bounds",
        "ml_ready_table": ready,
        "vector_roundtrip": ready,
        "scaled_features": f"{WITH_READY}, deviations AS (SELECT {deviations} FROM ready WHERE {in_train()}) "
        f"SELECT flow_id, {unit} FROM ready, deviations WHERE NOT ({in_train()})",
        "confusion_sparse": f"{WITH_CELLS} SELECT * FROM cells ORDER BY model, label, prediction",
        "confusion_dense": f"{WITH_CELLS} SELECT model, "
        + ", ".join(
            f"coalesce(sum(count) FILTER (label = {a} AND prediction = {b}), 0)::BIGINT AS {n}"
            for n, a, b in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
        )
        + " FROM cells GROUP BY model",
        "confusion_normalised": f"{WITH_CELLS} SELECT *, "
        "round(count / max(count) OVER (PARTITION BY model), 6) AS share FROM cells",
        "class_metrics": f"{WITH_CLASSES} SELECT model, class, rows, hits, round(precision, 9) AS precision, "
        "round(recall, 9) AS recall, round(f1, 9) AS f1 FROM classes",
        "metrics_long": f"{WITH_LONG} SELECT model, metric, round(value, 9) AS value FROM long",
        "metrics_wide": f"{WITH_WIDE} SELECT model, {wide} FROM wide",
        "metrics_rounded": f"{WITH_WIDE} SELECT model, {wide4}, replace(model, 'Model ', '') AS short_name, "
        "replace(replace(lower(model), ' ', '_'), '-', '') AS slug FROM wide",
        "best_model": f"{WITH_LONG} SELECT model, round(value, 9) AS value FROM long WHERE metric = 'f1' "
        "ORDER BY long.value DESC, model LIMIT 1",
        "best_per_metric": f"{WITH_LONG} SELECT metric, model, round(value, 9) AS value FROM (SELECT *, "
        "rank() OVER (PARTITION BY metric ORDER BY value DESC) AS place FROM long) WHERE place = 1",
        "metric_delta": f"{WITH_LONG} SELECT l.model, l.metric, round(l.value, 9) AS value, "
        "round(b.value, 9) AS baseline, round(l.value - b.value, 9) AS change FROM long l "
        f"JOIN long b ON l.metric = b.metric AND b.model = '{BASELINE}'",
        "model_counts": f"{WITH_SCORED} SELECT count(*) AS models, max(n) AS rows_per_model FROM "
        "(SELECT model, count(*) AS n FROM scored GROUP BY model)",
        "roc_points": WITH_RANKED.format(scored=WITH_SCORED)
        + """, points AS (SELECT model, score, tp, fp FROM ranked
             WHERE p_before IS NULL OR p_next IS NULL OR p_next <> p OR n_next <> n
             UNION ALL SELECT model, NULL, 0, 0 FROM sums)
           SELECT model, score, tp, fp, round(tp / positives, 9) AS tpr, round(fp / negatives, 9) AS fpr
           FROM points JOIN sums USING (model)""",
        "auc_exact": WITH_RANKED.format(scored=WITH_SCORED)
        + f", area AS ({AREA}) SELECT model, round(auc_roc, 12) AS auc_roc FROM area",
        "pruned_scan": "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY ALL",
        "file_union_rows": clean_rows,
        "table_round_trip": clean_rows,
        "csv_ingest": clean_rows,
        "report_round_trip": f"{WITH_CLEANED} SELECT label, count(*) AS count, format FROM cleaned, "
        "(VALUES ('json'), ('csv')) f(format) GROUP BY label, format",
        "sample_export": f"{WITH_CLEANED} SELECT label, flow_id, duration, bytes_rate FROM cleaned "
        "ORDER BY flow_id LIMIT 50",
        "schema_table": f"{WITH_TYPED} {types}",
        "incremental_ingest": f"{WITH_FLOWS} SELECT 1::INTEGER AS run, count(*) FILTER ({in_train()}) AS added FROM flows "
        f"UNION ALL SELECT 2, count(*) FILTER (NOT ({in_train()})) FROM flows UNION ALL SELECT 3, 0",
        "resumable_stage": f"{WITH_CLEANED} SELECT run::INTEGER AS run, status, count(*) AS rows FROM cleaned, "
        "(VALUES (1, 'written'), (2, 'skipped')) r(run, status) GROUP BY run, status",
        "tolerant_scan": "SELECT 'lineitem' AS input, TRUE AS found, count(*) AS rows FROM lineitem "
        "UNION ALL SELECT 'no_such_table', FALSE, 0",
        "split_rows": f"{WITH_FLOWS}, keyed AS (SELECT CASE WHEN fwd_packets_count <> '7' THEN flow_id END AS flow_id FROM flows) "
        f"SELECT CASE WHEN {in_train()} THEN 'train' ELSE 'test' END AS part, count(*) AS rows, "
        "count(*) FILTER (flow_id IS NULL) AS without_key FROM keyed GROUP BY 1",
        "approx_bounds_within_error": " UNION ALL ".join(
            f"SELECT '{m}' AS \"column\", {p}::DOUBLE AS probability, TRUE AS within" for m in MEASURES for p in (0.01, 0.99)
        ),
        "approx_bounds_beyond_sketches": " UNION ALL ".join(
            f"SELECT '{m}' AS \"column\", {p}::DOUBLE AS probability, TRUE AS within" for m in MEASURES for p in (0.01, 0.99)
        ),
        "quarantined_lines": f"{WITH_FLOWS}, lines AS (SELECT CASE WHEN bwd_packets_count = '0' THEN concat_ws(',', flow_id, duration) "
        "WHEN fwd_packets_count = '7' THEN concat_ws(',', flow_id, duration, fwd_packets_count, 'more') "
        "ELSE concat_ws(',', flow_id, duration, fwd_packets_count) END AS line, "
        "bwd_packets_count = '0' OR fwd_packets_count = '7' AS quarantined FROM flows) "
        "SELECT quarantined, line, CASE WHEN quarantined THEN TRUE END AS named FROM lines",
        "observed_quality": f"{WITH_FLOWS} SELECT 'rows' AS \"check\", 'label' AS \"column\", count(*) AS rows FROM flows "
        "UNION ALL SELECT 'label_missing', 'label', count(*) FROM flows WHERE label IS NULL "
        f"UNION ALL SELECT 'cast_failed', 'note', count(*) FROM flows WHERE flow_id NOT IN ({IN_LIST}) AND TRY_CAST(flow_id AS DOUBLE) IS NULL",
        "rescored_partition": f"{WITH_SCORED} SELECT model, count(*) AS rows, "
        f"sum(CASE WHEN model <> '{list(SCORED_LIFTS)[1]}' THEN prediction WHEN score >= 300 THEN 1 ELSE 0 END)::BIGINT AS called, "
        f"model <> '{list(SCORED_LIFTS)[1]}' AS files_kept FROM scored GROUP BY model",
        "class_numbers": f"{WITH_FOUND} SELECT place AS class_index, class FROM numbers",
        "multiclass_report": f"{WITH_REPORT} SELECT model, class, rows, hits, round(precision, 9) AS precision, "
        "round(recall, 9) AS recall, round(f1, 9) AS f1, round(auc_roc, 9) AS auc_roc FROM report",
        "multiclass_macro": f"{WITH_REPORT} SELECT model, count(*) AS classes, round(avg(precision), 9) AS precision, "
        "round(avg(recall), 9) AS recall, round(avg(f1), 9) AS f1, round(avg(auc_roc), 9) AS auc_roc FROM report GROUP BY model",
        "multiclass_confusion": f"{WITH_FOUND}, cells AS (SELECT label, prediction, count(*) AS n FROM found GROUP BY ALL) "
        "SELECT 'made up' AS model, a.class AS actual, p.class AS predicted, coalesce(n, 0) AS count "
        f"FROM numbers a JOIN numbers p ON p.place < {CLASSES_KNOWN} LEFT JOIN cells ON label = a.place AND prediction = p.place",
        "class_weights": f"{WITH_CLEANED} SELECT label, count(*) AS rows, "
        "round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 9) AS weight FROM cleaned GROUP BY label",
        "weighted_confusion": f"{WITH_SCORED}, sizes AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS k "
        "FROM scored GROUP BY label) SELECT model, label, prediction, count(*) AS count, round(count(*) * max(total / (k * n)), 6) AS weight "
        "FROM scored JOIN sizes USING (label) GROUP BY ALL",
        "saved_model_scores": f"{WITH_CLEANED} SELECT {TARGET} AS label, count(*) AS rows, count(*) AS as_fitted "
        f"FROM cleaned WHERE NOT ({in_train()}) GROUP BY 1",
        "saved_pipeline_vectors": f"{WITH_ENGINEERED}, bounds AS ({bounds('engineered', FEATURES)} WHERE {in_train()}), ready AS "
        "(SELECT flow_id, " + ", ".join(f"coalesce({capped(f)}, 0.0) AS {f}" for f in FEATURES)
        + f" FROM engineered, bounds WHERE NOT ({in_train()})) SELECT flow_id, {ROUNDED_LOGS} FROM ready",
        "fold_bounds": f"{WITH_ENGINEERED}, folded AS (SELECT *, {FOLD} AS fold FROM engineered), bounds AS ("
        + " UNION ALL ".join(
            f"SELECT {i}::INTEGER AS fold, '{f}' AS \"column\", quantile_disc({f}, 0.01) AS low, quantile_disc({f}, 0.99) AS high "
            f"FROM folded WHERE fold <> {i}"
            for i in range(FOLDS)
            for f in FEATURES
        )
        + ') SELECT fold, "column", round(low, 6) AS low, round(high, 6) AS high FROM bounds WHERE low < high',
        "validation_folds": f"{WITH_FLOWS}, keyed AS (SELECT label, CASE WHEN fwd_packets_count <> '7' THEN flow_id END AS flow_id FROM flows) "
        f"SELECT {FOLD} AS fold, label, count(*) AS rows FROM keyed GROUP BY 1, 2",
        "tuned_settings": f"{WITH_CLEANED} SELECT {FOLD} AS fold, setting, count(*) AS rows, 5::BIGINT AS in_unit, TRUE AS best_mean "
        f"FROM cleaned, (VALUES {', '.join(f"""('{{"elasticNetParam": 0.0, "regParam": {r}}}')""" for r in ('0.0', '0.3'))}) s(setting) "
        f"WHERE {in_train()} GROUP BY 1, 2",
        "multiclass_model": f"{WITH_CLEANED} SELECT coalesce(label, '(unseen)') AS class, count(*) AS rows, TRUE AS as_counted, TRUE AS area "
        f"FROM cleaned WHERE NOT ({in_train()}) GROUP BY 1",
        "raw_stream_score": f"{WITH_CLEANED} SELECT run::INTEGER AS run, {TARGET} AS label, count(*) AS rows, count(*) AS as_batch "
        f"FROM cleaned, range(1, 4) runs(run) WHERE run > 1 OR {percent_of('flow_id')} < 50 GROUP BY 1, 2",
        "auc_binned": f"{WITH_SCORED} SELECT DISTINCT model, TRUE AS near FROM scored",
        "score_coverage": WITH_RANKED.format(
            scored=WITH_SCORED.replace("WITH scored AS", "WITH every AS")
            + ", scored AS (SELECT * FROM every WHERE score % 50 NOT IN (0, 1))"
        )
        + f", area AS ({AREA}), covered AS (SELECT model, count(*) AS rows, "
        "count(*) FILTER (score % 50 NOT IN (0, 1)) AS scored, count(*) FILTER (score % 50 = 0) AS null_scores, "
        "count(*) FILTER (score % 50 = 1) AS nan_scores FROM every GROUP BY model) "
        "SELECT covered.*, round(auc_roc, 12) AS auc_roc FROM covered JOIN area USING (model)",
        "recall_by_class": f"{WITH_SCORED} SELECT model, line_class AS class, count(*) AS rows, "
        "count(*) FILTER (label = prediction) AS found, round(count(*) FILTER (label = prediction) / count(*), 9) AS recall "
        "FROM scored GROUP BY ALL",
        "header_normalise": f"{WITH_FLOWS} SELECT flow_id, duration, trim(label) AS label FROM flows",
        "quality_report": f"{WITH_CLEANED} SELECT 'cast_failed' AS \"check\", 'flow_id' AS \"column\", count(*) AS rows FROM flows "
        f"WHERE flow_id NOT IN ({IN_LIST}) AND TRY_CAST(flow_id AS DOUBLE) IS NULL "
        "UNION ALL SELECT 'label_missing', 'label', count(*) FROM flows WHERE label IS NULL "
        "UNION ALL SELECT 'all_null', 'nothing', count(*) FROM cleaned "
        "UNION ALL SELECT 'constant', 'same', count(*) FROM cleaned "
        "UNION ALL SELECT 'infinite', 'endless', count(*) FROM cleaned WHERE duration > 40",
        "stage_exports": f"{WITH_CLEANED}, counted AS (SELECT count(*) AS n, count(DISTINCT coalesce(label, '?')) AS classes, "
        f"count(DISTINCT {TARGET}) AS targets FROM cleaned) "
        "SELECT 'samples/cleaned' AS export, least(n, 50) AS rows FROM counted "
        "UNION ALL SELECT 'samples/ml_ready', least(n, 50) FROM counted "
        "UNION ALL SELECT 'schemas/cleaned', 9 UNION ALL SELECT 'schemas/ml_ready', 4 "
        "UNION ALL SELECT 'reports_csv/classes', classes FROM counted "
        "UNION ALL SELECT 'reports_json/classes', classes FROM counted "
        "UNION ALL SELECT 'reports_csv/targets', targets FROM counted "
        "UNION ALL SELECT 'reports_json/targets', targets FROM counted "
        "UNION ALL SELECT 'reports_csv/stages', 2 UNION ALL SELECT 'reports_json/stages', 2 "
        "UNION ALL SELECT 'reports_csv/quality', 1 UNION ALL SELECT 'reports_json/quality', 1",
        **{
            name: f"{WITH_CLEANED}, test AS (SELECT {TARGET} AS label FROM cleaned WHERE NOT ({in_train()})) "
            f"SELECT '{model}' AS model, label, count(*) AS rows, count(*) AS in_unit, count(*) AS classes, TRUE AS fair "
            "FROM test GROUP BY label"
            for name, model in (("score_lr", MODEL_LR), ("score_mlp", MODEL_MLP), ("score_rf", MODEL_RF))
        },
        "feature_importance": f"SELECT {len(FEATURES)}::BIGINT AS features, {len(FEATURES)}::BIGINT AS valid, TRUE AS sums_to_one",
        "stream_score": f"{WITH_CLEANED} SELECT {TARGET} AS label, count(*) AS rows, count(*) AS as_batch FROM cleaned GROUP BY 1",
        "model_comparison": f"{WITH_CLEANED} SELECT model, count(*) AS rows, TRUE AS as_counted, TRUE AS area FROM cleaned, "
        f"(VALUES {names}) m(model) WHERE NOT ({in_train()}) GROUP BY model",
        "prediction_lineage": f"{WITH_CLEANED} SELECT model, label AS label_original, {TARGET} AS label, "
        "count(*) AS rows, count(*) AS sums_to_one, count(*) AS follows_probability FROM cleaned, "
        f"(VALUES {names}) m(model) WHERE NOT ({in_train()}) GROUP BY 1, 2, 3",
    }
