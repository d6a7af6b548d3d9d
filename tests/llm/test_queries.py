import __spark_entry__ as entry_points


def test_every_operator_and_the_pipeline_are_listed():
    names = entry_points.queries()
    assert sorted(int(n.split("_")[0][2:]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names
    assert {"op1_warc", "op9_mixing", "op10_exact_dedup", "op12_spelling"} <= set(entry_points.oracle_sql())
