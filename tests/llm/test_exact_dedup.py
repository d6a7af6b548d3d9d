import hashlib

import pytest
from pyspark.sql import functions as F

from flowlab.llm import exact_dedup
from flowlab.sources.storage import new_folder
from tests.llm.edge import CLASHES, ROWS, edge_docs, no_docs


def expected(rows) -> list[tuple]:
    """(id, keep_id, size, sha256) per row; None is the smallest id."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    order = lambda i: (i is not None, i or 0)
    return [
        (r[0], max(groups[r[1] or ""], key=order), len(groups[r[1] or ""]), hashlib.sha256((r[1] or "").encode()).hexdigest())
        for r in rows
    ]


def weak(text):
    """Three digests for all texts: most groups are collisions."""
    return F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0"))


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
@pytest.mark.parametrize("files", [1, 1000])
def test_edges(spark, digest, files):
    docs = edge_docs(spark).repartition(3)
    found = exact_dedup.deduplicate(docs, digest=digest, files_per_batch=files).collect()
    got = [(r.id, r.keep_id, r.group_size) for r in found]
    assert sorted(got, key=str) == sorted((e[:3] for e in expected(ROWS)), key=str)
    assert sum(r.kept for r in found) == len({r[1] or "" for r in ROWS})
    assert all(r.id == r.keep_id for r in found if r.kept)
    if digest is exact_dedup.sha256:
        digests = {(r.id, bytes(r.digest).hex()) for r in found}
        assert digests == {(e[0], e[3]) for e in expected(ROWS)}


def test_unique_rows_keep_their_columns(spark):
    docs = edge_docs(spark)
    rows = exact_dedup.unique_rows(docs).collect()
    assert rows[0].asDict().keys() == set(docs.columns)
    assert len(rows) == len({r[1] or "" for r in ROWS})
    assert all(r[c] == f"other {c}" for r in rows for c in CLASHES)


def test_other_column_names(spark):
    docs = edge_docs(spark).withColumnsRenamed({"doc_id": "key", "text": "body"})
    rows = exact_dedup.unique_rows(docs, id_col="key", text_col="body").collect()
    assert len(rows) == len({r[1] or "" for r in ROWS})


def test_state_outlives_a_run(spark):
    """Rows admitted later meet what earlier runs have seen."""
    folder = new_folder(spark, "kept-state")
    first = spark.createDataFrame([(1, "x"), (2, "y")], "doc_id bigint, text string")
    later = spark.createDataFrame([(3, "x"), (0, "y"), (4, "z")], "doc_id bigint, text string")
    assert all(r.kept for r in exact_dedup.deduplicate(first, folder=folder).collect())
    found = exact_dedup.deduplicate(later, folder=folder).collect()
    assert {(r.id, r.keep_id, r.group_size) for r in found} == {(1, 3, 2), (2, 2, 2), (3, 3, 2), (0, 2, 2), (4, 4, 1)}


def test_settings_of_the_session_stay(spark):
    names = list(exact_dedup.STATE_SETTINGS)
    before = [spark.conf.get(n, None) for n in names]
    exact_dedup.deduplicate(spark.createDataFrame([(1, "x")], "doc_id bigint, text string")).collect()
    assert [spark.conf.get(n, None) for n in names] == before


def test_empty(spark):
    assert exact_dedup.deduplicate(no_docs(spark)).collect() == []
    assert exact_dedup.unique_rows(no_docs(spark)).collect() == []


def test_places_go_on_after_a_single_row(spark, tmp_path):
    """The first admission's only place is 0, which is a place and not none."""
    folder = str(tmp_path / "one")
    for rows in ([(1, "a")], [(2, "b"), (3, "a")]):
        exact_dedup.admit(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), folder)
    exact_dedup.track(spark, folder)
    found = exact_dedup.resolve(spark, folder).collect()
    assert len({r.place for r in found}) == 3
    assert {r.id for r in found if r.kept} == {2, 3}
