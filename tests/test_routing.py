"""routing_cost on tables with more types than the given ones, a null type, and none."""

import duckdb
from orrery.plans import catalogue


def test_every_type_is_audited(spark, tmp_path):
    rows = [(i, i // 2, None if i % 8 == 7 else f"type {i % 8}", float(i % 20)) for i in range(160)]
    for name, part in (("some", rows), ("none", [])):
        path = f"{tmp_path}/{name}/events.parquet"
        spark.createDataFrame(part, "event_id long, user_id long, event_type string, value double").write.parquet(path)
        df = catalogue.queries()["routing_cost"](spark, f"{tmp_path}/{name}")
        if part:
            con = duckdb.connect()
            con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/*.parquet'")
            want = con.execute(catalogue.oracle_sql()["routing_cost"]).fetchall()
            assert len(want) == 8 and sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want))
        else:
            assert df.columns == ["event_type", "n", "misrouted", "costly"] and df.count() == 0
