"""Resumable stages: clean, features, models, scores, comparison, exports, each with a marker."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from typing import NamedTuple

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.operators import features, metrics, profile, quality
from flowlab.operators.clean import clean_flows
from flowlab.operators.models import SCORE, TRAINERS, fit_named, load_model, predict, save_model, split
from flowlab.sources import exports
from flowlab.sources.storage import complete, exists, mark_complete, read_text, remove_marker, write_text
from flowlab.sources.tables import read_table, replace_partitions, write_table

SAMPLE_ROWS = 50


class Stage(NamedTuple):
    """What a stage did: ``rows`` is the number written, or None where the stage was skipped."""

    name: str
    path: str
    status: str
    rows: int | None


@dataclass(frozen=True)
class Options:
    """How the tables are prepared. Other options make other tables, so they redo the stages."""

    key: str = "flow_id"
    keep_nulls: bool = False
    strict: bool = False
    deduplicate: bool = False
    caps_from: str = "all"  # rows that outlier bounds are fitted on: "all" or "train"
    exact_caps: bool = False
    exclude: tuple[str, ...] = ()  # columns that are no features, such as ports


def _marks(path: str) -> str:
    return f"{path}.settings"


def fingerprint(spark: SparkSession, settings: dict | None, needs: Iterable[str]) -> str:
    """What a result depends on: its own settings, and those of the results that it is made from."""
    return json.dumps({"settings": settings or {}, "needs": {p: read_text(spark, _marks(p)) for p in needs}}, sort_keys=True)


def _stage(
    spark: SparkSession, name: str, path: str, needs: Iterable[str], settings: dict | None, work: Callable[[], int | None]
) -> Stage:
    """Do ``work`` unless a finished result of the same settings is at ``path``; ``work`` leaves the marker
    there and returns the rows it wrote.

    Missing inputs fail before any work, and the result must carry its marker afterwards. Settings
    lie next to the result and are written first, so that a result never passes for one of others.
    """
    needs = list(needs)
    wanted = fingerprint(spark, settings, needs)
    if complete(spark, path) and read_text(spark, _marks(path)) == wanted:
        return Stage(name, path, "skipped", None)
    missing = [p for p in needs if not exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"stage {name} needs {', '.join(missing)}")
    remove_marker(spark, path)
    write_text(spark, _marks(path), wanted)
    rows = work()
    if not complete(spark, path):
        raise RuntimeError(f"stage {name} left no marker in {path}")
    return Stage(name, path, "written", rows)


def materialize(
    spark: SparkSession,
    name: str,
    path: str,
    build: Callable[[], DataFrame],
    needs: Iterable[str] = (),
    partition_by: Iterable[str] = (),
    settings: dict | None = None,
) -> Stage:
    """A stage whose result is a table. The rows are counted from the written files' footers."""

    def work() -> int:
        write_table(build(), path, partition_by)
        return read_table(spark, path).count()

    return _stage(spark, name, path, needs, settings, work)


def materialize_model(
    spark: SparkSession,
    name: str,
    path: str,
    fit: Callable[[], Model],
    needs: Iterable[str] = (),
    settings: dict | None = None,
) -> Stage:
    """A stage whose result is a fitted model; ``load_model`` reads it."""

    def work() -> None:
        save_model(fit(), path)
        mark_complete(spark, path)

    return _stage(spark, name, path, needs, settings, work)


def slug(model: str) -> str:
    """A model's directory name, by the rule of ``metrics.slug``."""
    return model.lower().replace(" ", "_").replace("-", "")


def prepare_cleaned(
    spark: SparkSession,
    raw: Callable[[], DataFrame],
    folder: str,
    options: Options = Options(),
    watch: quality.Watch | None = None,
) -> Stage:
    """Raw flows to cleaned flows, the table that every later scan reads, in one pass without a shuffle.
    ``watch`` counts the raw rows and their faults in the job that writes."""
    rules = {"keep_nulls": options.keep_nulls, "strict": options.strict, "deduplicate": options.deduplicate}

    def build() -> DataFrame:
        rows = raw()
        return clean_flows(watch.over(rows) if watch else rows, **rules)

    return materialize(spark, "cleaned", f"{folder}/cleaned", build, settings=rules | {"key": options.key})


def prepare_counted(
    spark: SparkSession, raw: Callable[[], DataFrame], folder: str, options: Options = Options()
) -> list[Stage]:
    """``prepare_cleaned`` and the quality of the raw rows, both from one pass over them.

    The counts are a stage of their own. Where the cleaned rows are there and the counts are not, say
    because a run was cut short in between, the raw table is counted by itself.
    """
    watch = quality.Watch()
    cleaned = prepare_cleaned(spark, raw, folder, options, watch)

    def report() -> DataFrame:
        return watch.report(spark) if watch.observation else quality.counted_raw(raw())

    return [cleaned, materialize(spark, "raw_counts", f"{folder}/raw_counts", report, [cleaned.path])]


def ready_table(cleaned: DataFrame, options: Options = Options()) -> DataFrame:
    """Cleaned flows to vectors, outliers capped at bounds of all rows or of the training rows."""
    made = features.engineered(cleaned)
    columns = features.numeric_columns(made, ("label", "label_original", *options.exclude))
    fitted = split(made, options.key)[0] if options.caps_from == "train" else made
    caps = features.fit_caps(fitted, columns, exact=options.exact_caps)
    filled = features.fill_missing(features.apply_caps(made, caps), columns)
    return features.assemble(filled, columns, options.key)


def prepare(
    spark: SparkSession, raw: Callable[[], DataFrame], folder: str, options: Options = Options()
) -> list[Stage]:
    """Raw flows to cleaned flows, with their counts, to the ml-ready table."""
    cleaned, _ = prepare_counted(spark, raw, folder, options)
    ready = materialize(
        spark,
        "ml_ready",
        f"{folder}/ml_ready",
        lambda: ready_table(read_table(spark, cleaned.path), options),
        [cleaned.path],
        settings=asdict(options) | {"exclude": list(options.exclude)},
    )
    return [cleaned, ready]


def report_quality(
    spark: SparkSession, raw: Callable[[], DataFrame], folder: str, options: Options = Options()
) -> Stage:
    """What is wrong with the raw table and with its features, as a small table; the raw table's part was
    counted when it was cleaned."""
    cleaned, counts = f"{folder}/cleaned", f"{folder}/raw_counts"

    def report() -> DataFrame:
        made = features.engineered(read_table(spark, cleaned))
        columns = features.numeric_columns(made, ("label", "label_original", *options.exclude))
        raw_part = read_table(spark, counts).filter("check <> 'rows'")
        return raw_part.unionByName(quality.feature_quality(made, columns))

    return materialize(spark, "quality", f"{folder}/quality", report, [cleaned, counts])


def model_path(folder: str, model: str) -> str:
    return f"{folder}/models/{slug(model)}"


def predictions_path(folder: str, model: str) -> str:
    """Where the marker and settings of a model's predictions lie: hidden in the table of all models."""
    return f"{predictions_table(folder)}/_stages/{slug(model)}"


def predictions_table(folder: str) -> str:
    return f"{folder}/predictions"


def read_predictions(spark: SparkSession, folder: str, models: Iterable[str], columns: list[str] | None = None) -> DataFrame:
    """The scored rows of some models; files of others are not read."""
    table = read_table(spark, predictions_table(folder))
    names = columns or ["model", *(c for c in table.columns if c != "model")]
    return table.filter(F.col("model").isin(*models)).select(*names)


def train(spark: SparkSession, folder: str, model: str, **settings) -> Stage:
    """Fit one model on the training rows of the ml-ready table and save it."""
    ml_ready = f"{folder}/ml_ready"
    return materialize_model(
        spark,
        f"{model}, fitted",
        model_path(folder, model),
        lambda: fit_named(model, read_table(spark, ml_ready), **settings),
        [ml_ready],
        settings,
    )


def score(spark: SparkSession, folder: str, model: str, **settings) -> Stage:
    """Score the test rows of the ml-ready table with the saved model, which is fitted first if there is
    none of these settings. All models share one table; only this model's partition is written."""
    ml_ready, path = f"{folder}/ml_ready", predictions_path(folder, model)
    train(spark, folder, model, **settings)

    def work() -> int:
        test = split(read_table(spark, ml_ready))[1]
        scored = predict(load_model(model_path(folder, model)), test, model)
        replace_partitions(scored, predictions_table(folder), ["model"], gather=False)
        mark_complete(spark, path)
        return read_predictions(spark, folder, [model]).count()

    return _stage(spark, model, path, [ml_ready, model_path(folder, model)], settings, work)


def compare(spark: SparkSession, folder: str, models: Iterable[str] = tuple(TRAINERS)) -> list[Stage]:
    """Metrics and confusion counts of all models, from one pass over their rows."""
    models = list(models)
    parts = [predictions_path(folder, m) for m in models]
    outcomes, comparison = f"{folder}/comparison/outcomes", f"{folder}/comparison"

    def counted() -> DataFrame:
        scored = read_predictions(spark, folder, models, ["model", "label", "prediction", SCORE])
        return metrics.outcome_counts(scored, SCORE)

    def stored() -> DataFrame:
        return read_table(spark, outcomes)

    return [
        materialize(spark, "outcomes", outcomes, counted, parts),
        materialize(spark, "metrics", f"{comparison}/metrics", lambda: metrics.metrics_of(stored()), [outcomes]),
        materialize(spark, "confusion", f"{comparison}/confusion", lambda: metrics.confusion_of(stored()), [outcomes]),
    ]


def _finished(spark: SparkSession, folder: str, names: dict[str, str]) -> dict[str, str]:
    return {name: path for name, path in names.items() if complete(spark, f"{folder}/{path}")}


def export(spark: SparkSession, folder: str, models: Iterable[str] = tuple(TRAINERS), key: str = "flow_id") -> list[str]:
    """Readable copies of all finished stages under ``exports``; returns what was written.

    Per table a sample of its first rows by key as CSV, and its schema; per report one CSV and one JSON
    file: classes, stage counts, quality, metrics, confusion counts.
    """
    tables = {"cleaned": "cleaned", "ml_ready": "ml_ready"}
    scored = {slug(m): m for m in models if complete(spark, predictions_path(folder, m))}
    written = []

    def out(kind: str, name: str) -> str:
        written.append(f"{kind}/{name}")
        return f"{folder}/exports/{kind}/{name}"

    found = {name: read_table(spark, f"{folder}/{path}") for name, path in _finished(spark, folder, tables).items()}
    found |= {name: read_predictions(spark, folder, [model]) for name, model in scored.items()}
    for name, rows in found.items():
        exports.write_csv(exports.sample_rows(rows, SAMPLE_ROWS, key), out("samples", name), one_file=True)
        exports.write_csv(exports.schema_table(rows), out("schemas", name), one_file=True)
    reports = {}
    if "cleaned" in found:
        reports["classes"] = profile.class_share(found["cleaned"], "label")
    if "ml_ready" in found:
        reports["targets"] = profile.distribution(found["ml_ready"], "label", largest_first=False)
        reports["stages"] = profile.reconcile((n, found[n]) for n in ("cleaned", "ml_ready") if n in found)
    named = {"quality": "quality", "metrics": "comparison/metrics", "confusion": "comparison/confusion"}
    reports |= {name: read_table(spark, f"{folder}/{path}") for name, path in _finished(spark, folder, named).items()}
    for name, rows in reports.items():
        exports.write_csv(rows, out("reports_csv", name), one_file=True)
        exports.write_json(rows, out("reports_json", name), one_file=True)
    return written


def run_stages(
    spark: SparkSession,
    raw: Callable[[], DataFrame],
    folder: str,
    models: Iterable[str] = tuple(TRAINERS),
    settings: dict[str, dict] | None = None,
    options: Options = Options(),
    exported: bool = False,
) -> list[Stage]:
    """Raw flows to model comparison under ``folder``; a second call only does what is missing or was
    made with other settings. ``exported`` also writes the readable copies."""
    models = list(models)
    scores = [(m, (settings or {}).get(m, {})) for m in models]
    done = [
        *prepare(spark, raw, folder, options),
        report_quality(spark, raw, folder, options),
        *(score(spark, folder, m, **given) for m, given in scores),
        *compare(spark, folder, models),
    ]
    if exported:
        export(spark, folder, models, options.key)
    return done


def stage_status(spark: SparkSession, paths: Iterable[str]) -> list[tuple[str, bool]]:
    """(path, finished) for each path."""
    return [(p, complete(spark, p)) for p in paths]
