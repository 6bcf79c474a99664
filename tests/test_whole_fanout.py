"""The denormalized fan-out by receiver, and each variant counted on its own rows."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from feedloom.functions import payload as PL
from feedloom.plans import batch, registry
from feedloom.plans.registry import QUERIES


def test_payload_rows_name_their_receivers(spark):
    rows = QUERIES["fanout_denorm_receivers"](spark, SF_SMALL)
    assert rows.columns == ["uid", "time", "tid", "payload_id", "text_md5"]
    norm = QUERIES["fanout_norm"](spark, SF_SMALL)
    assert rows.filter("payload_id is null or payload_id <> tid").count() == 0
    assert rows.select("uid", "time", "tid").exceptAll(norm).count() == 0 == norm.count() - rows.count()


def test_every_variant_is_counted_on_its_own_rows(spark, monkeypatch):
    real, seen = batch.batch_tables, []

    def tables(spark, sf_dir, cfg):
        seen.append((cfg.layout, cfg.store))
        rows = real(spark, sf_dir, cfg)
        if cfg.layout == "norm":
            return rows
        return {"feedslists": rows["feedslists"].withColumn("tweet", F.when(F.col("tid") % 2 == 0, F.col("tweet")))}

    monkeypatch.setattr(batch, "batch_tables", tables)
    out = QUERIES["fanout_variants"](spark, SF_SMALL)
    n = {(r["layout"], r["store"]): r["n_rows"] for r in out.collect()}
    assert sorted(seen) == sorted(n) and len(n) == 4
    assert all(0 < n["denorm", s] < n["norm", s] for s in ("set", "list"))


def test_every_receivers_row_carries_its_payload(spark):
    rows = batch.denorm_rows(spark, SF_SMALL, registry.CFG, {"payload_id": PL.payload_id(F.col("tweet"))})
    assert PL.is_payload(rows, "tweet")
    shown = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
             if "Join " in line or "AS payload_id" in line]
    assert "AS payload_id" in shown[0] and "Join " in shown[1]       # taken from what the fan-out made, not before it
    text = rows.select("uid", "tid", PL.text(F.col("tweet")).alias("text"))
    want = QUERIES["parse_tweets"](spark, SF_SMALL).select("tid", F.col("text").alias("whole"))
    assert text.join(want, "tid").filter(~F.col("text").eqNullSafe(F.col("whole"))).count() == 0 < text.count()
