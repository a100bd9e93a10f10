from __future__ import annotations

from pyspark.sql import functions as F

from slotcast.registry.queries import REGISTRY
from slotcast.sources import views as v


def test_retained_load_keeps_the_whole_retention(spark, sf_dir):
    kept = REGISTRY["retained_load"](spark, sf_dir)
    loads = v.slot_loads(spark, sf_dir)
    assert kept.count() == loads.count()
    assert kept.agg(F.min("datetime")).first() == loads.agg(F.min("datetime")).first()
