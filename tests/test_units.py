"""Units of a small listing, with nulls, repeats, overlapping stores and empty tables."""

from corvane.operators import units


def test_units_of_stores_and_of_what_they_leave(spark):
    files = spark.createDataFrame([("a/x/1/f",), ("a/x/1/g",), ("a/x/1/g",), ("a/x/h",), ("a/y/2/f",), ("b/f",), ("f",), (None,), ("ax/f",)], "path string")
    selections = spark.createDataFrame([("logs", "a/<provider>", 1), ("all", "a", 1), ("none", None, 1)], "name string, template string, depth int")
    providers = spark.createDataFrame([("logs", "x"), ("logs", "z"), ("other", "y")], "name string, provider string")
    stores = units.declared(selections, providers)
    assert {tuple(r) for r in stores.collect()} == {("logs", "x", "a/x", 1), ("logs", "z", "a/z", 1), ("all", None, "a", 1), ("none", None, None, 1)}
    of_stores = {("logs", "x", "a/x/1", 2), ("logs", "x", "a/x/h", 1), ("all", None, "a/x", 3), ("all", None, "a/y", 1)}
    assert {tuple(r) for r in units.scanned(files, stores).collect()} == of_stores
    rest = {(r.address, r.files) for r in units.all_units(files, stores).where("measure = 'prefix'").collect()}
    assert rest == {("b/f", 1), ("f", 1), ("ax/f", 1)}
    assert units.all_units(files.where("false"), stores).count() == 0 and units.all_units(files, stores.where("false")).count() == 7


def test_missing_parts(spark):
    manifests = spark.createDataFrame([(1, "talks"), (1, "talks"), (2, "talks"), (2, "odd"), (3, None)], "unit long, category string")
    members = spark.createDataFrame([("talks", "a"), ("talks", "b")], "category string, member string")
    held = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, "a"), (2, None)], "unit long, member string")
    assert {tuple(r) for r in units.missing_parts(manifests, members, held).collect()} == {(2, "a"), (2, "unknown category odd"), (3, None)}
