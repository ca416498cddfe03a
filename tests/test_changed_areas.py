"""Enrichment of changed layers equals a full run over the new ones."""

import random

import pytest
from pyspark.sql import functions as F

from gridwise.functions.geometry import make_box
from gridwise.plans import enrich
from gridwise.plans.changed_areas import changed_polygons, update_areas

NAMES = [n for n in enrich.TOTAL_AREAS_COLUMNS if n not in
         ("stadsdeelcode", "stadsdeelnaam", "gebiedsnaam", "gebiedscode", "wijkcode", "wijknaam",
          "buurtnaam", "buurtcode", "lat", "lon")]


def _layer(spark, rows, columns):
    """rows: (names..., x0, y0) -> squares of 3 km."""
    df = spark.createDataFrame(rows, ", ".join([*(f"{c} string" for c in columns), "x0 int, y0 int"]))
    box = make_box(F.col("x0"), F.col("y0"), F.col("x0") + 3000, F.col("y0") + 3000, srid=28992)
    return df.select(*columns, box.alias("wkb_geometry"))


HIERARCHY = ["stadsdeelnaam", "stadsdeelcode", "wijknaam", "wijkcode", "buurtnaam", "buurtcode"]


def _hierarchy(spark, areas):
    return _layer(spark, [("s", "A", "w", f"A{i}", n, f"A{i}a", x, y) for i, (n, x, y) in areas.items()],
                  HIERARCHY)


def _working(spark, areas):
    return _layer(spark, [(n, f"G{i}", x, y) for i, (n, x, y) in areas.items()], ["naam", "code"])


OLD = {i: (f"n{i}", 110000 + 3000 * (i % 5), 480000 + 3000 * (i // 5)) for i in range(20)}
CHANGES = {
    "none": {},
    "moved": {7: ("n7", 112500, 486000)},
    # added, moved, dropped, renamed
    "all": {99: ("new", 111000, 481000), 7: ("n7", 112500, 486000), 3: None, 11: ("other", *OLD[11][1:])},
}


@pytest.fixture(scope="module")
def total(spark):
    rng = random.Random(9)
    rows = [(str(i), rng.uniform(4.72, 4.98), rng.uniform(52.29, 52.42)) for i in range(600)]
    rows += rows[:5] + [("none", None, None)]
    df = spark.createDataFrame(rows, "id string, lat double, lon double")
    return df.select(*[F.col("id").alias(n) for n in NAMES], "lat", "lon", F.lit(None).cast("string").alias("geom"))


def _rows(df):
    return sorted(tuple(r) for r in df.select(*enrich.TOTAL_AREAS_COLUMNS).collect())


@pytest.mark.parametrize("change,in_areas", [("none", False), ("all", False), ("moved", True)])
def test_update_equals_full_run(spark, total, change, in_areas):
    new = {i: v for i, v in {**OLD, **CHANGES[change]}.items() if v}
    layers = [_hierarchy(spark, OLD), _hierarchy(spark, OLD if in_areas else new),
              _working(spark, OLD), _working(spark, new if in_areas else OLD)]
    published = enrich.inspections_total_areas(total, layers[0], layers[2]).cache()
    got = _rows(update_areas(published, total, *layers))
    want = _rows(enrich.inspections_total_areas(total, layers[1], layers[3]))
    assert got == want and len(got) > 100
    assert (got == _rows(published)) == (change == "none")


def test_changed_polygons_are_those_of_changed_rows(spark):
    old, new = _hierarchy(spark, OLD), _hierarchy(spark, {**OLD, 7: ("n7", 112500, 486000)})
    assert changed_polygons(old, new).count() == 2      # where it was and where it is
    assert changed_polygons(old, old.select(*reversed(old.columns))).count() == 0
