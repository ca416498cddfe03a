"""The incremental enrichment resumes from its checkpoint: rows landed after
a restart are processed once, earlier rows are not processed again."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gridwise.plans import enrich
from gridwise.plans import inputs as I
from gridwise.plans.loaders import inspection_types
from gridwise.streaming.incremental import enrichment_stream, start_enrichment

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data missing")


def test_stream_restart_exactly_once(spark):
    root = tempfile.mkdtemp(prefix="gridwise-stream-")
    t = I.Tables(spark, SF)
    area, obj = I.split_staging(I.insp_staging(t))
    types = inspection_types(I.type_docs_region(t), doc_order=["id", "_chunk"],
                             with_index=False)
    b6, w6, s6, g6 = I.rd_layers(t)
    hierarchy = enrich.area_hierarchy(b6, w6, s6)
    first = F.col("`location.locationId`") % 2 == 0

    def land(cond, tag):
        area.where(cond).write.mode("append").parquet(f"{root}/area")
        obj.where(cond).write.mode("append").parquet(f"{root}/object")

    def run():
        stream = enrichment_stream(spark, f"{root}/area", f"{root}/object", area.schema,
                                   types, hierarchy, g6)
        start_enrichment(stream, f"{root}/out", f"{root}/ckpt").awaitTermination()
        return spark.read.parquet(f"{root}/out")

    land(first, "a")
    n1 = run().count()
    land(~first, "b")                     # new files arrive after the restart
    out = run()
    batch = enrich.inspections_total_areas(enrich.inspections_total(area, obj, types),
                                           hierarchy, g6)
    assert 0 < n1 < out.count()
    key = ["location_id", "gebiedscode", "buurtcode"]
    assert out.groupBy(*key).count().where("count > 1").count() == 0   # no duplicates
    assert sorted(tuple(r) for r in out.select(*key).collect()) == \
        sorted(tuple(r) for r in batch.select(*key).collect())
