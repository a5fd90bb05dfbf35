"""Published waves: order, all or nothing, replaced months and snapshots, keys against the target."""

import pytest
from pyspark.sql import functions as F

from tramline.operators import rules
from tramline.plans import schemas, store

RULES = {
    "dim": rules.TableRules("dim", columns=("k", "name"), not_null=("k",), unique=("k",), empty="ok"),
    "fact": rules.TableRules("fact", columns=("k", "day", "v"), unique=("k", "day"), non_negative=("v",), empty="ok"),
}
FOREIGN = {"fact": {"k": ("dim", "k")}}


def dim(spark, names, mode="append", surrogate=("k", ("name",))):
    return store.Job("dim", lambda s: spark.createDataFrame([(n,) for n in names], "name string").select("name"), mode=mode, surrogate=surrogate)


def fact(spark, rows, mode="append"):
    frame = spark.createDataFrame(rows, "k int, day int, v int")
    return store.Job("fact", lambda s: frame, ("dim",), mode, lambda: F.floor(F.col("day") / 100).cast("int"))


def test_waves_follow_needs():
    job = lambda name, *needs: store.Job(name, None, needs)
    found = store.waves([job("c", "b", "a"), job("b", "a"), job("a"), job("d", "elsewhere")])
    assert [[j.name for j in w] for w in found] == [["a", "d"], ["b"], ["c"]]
    with pytest.raises(ValueError, match="need each other"):
        store.waves([job("a", "b"), job("b", "a")])
    with pytest.raises(ValueError, match="two jobs"):
        store.waves([job("a"), job("a")])


def test_all_or_nothing(spark, tmp_path, rows):
    s = store.Store(spark, str(tmp_path))
    assert s.entries() == (0, []) and s.find("dim") is None
    with pytest.raises(LookupError):
        s.read("dim")
    report = store.run(s, [fact(spark, [(1, 10101, 5), (2, 10102, 6)]), dim(spark, ["a", "b"])], RULES, FOREIGN)
    assert rows(report.select("wave", "table_name").distinct()) == [(0, "dim"), (1, "fact")]
    assert rows(s.read("fact")) == [(1, 10101, 5), (2, 10102, 6)] and s.entries()[0] == 2

    for bad, rule in [([(9, 10103, 1)], "foreign_key"), ([(1, 10101, 7)], "target_unique"), ([(1, 10109, -1)], "non_negative"), ([(1, 10109, 1)] * 2, "unique")]:
        with pytest.raises(rules.RejectedWave) as rejected:
            store.run_wave(s, [dim(spark, ["c"]), fact(spark, bad)], RULES, FOREIGN)
        assert {f.rule for f in rejected.value.failures} == {rule}
        for seen in (s, store.Store(spark, str(tmp_path))):
            assert seen.entries()[0] == 2 and rows(seen.read("dim").select("name")) == [("a",), ("b",)]
            assert rows(seen.read("fact")) == [(1, 10101, 5), (2, 10102, 6)]

    # A fact may refer to a member that the same wave brings.
    store.run_wave(s, [dim(spark, ["c"]), fact(spark, [(3, 10103, 0), (None, 10103, 0)])], RULES, FOREIGN)
    assert s.read("fact").count() == 4 and rows(s.read("dim").select("k", "name")) == [(1, "a"), (2, "b"), (3, "c")]


def test_months_and_snapshots_are_replaced(spark, tmp_path, rows):
    s = store.Store(spark, str(tmp_path))
    store.run(s, [dim(spark, ["a", "b"]), fact(spark, [(1, 10101, 5), (2, 10131, 6), (1, 10205, 7)], "periods")], RULES, FOREIGN)
    store.run(s, [fact(spark, [(1, 10102, 8)], "periods")], RULES, FOREIGN)  # January comes again
    assert rows(s.read("fact")) == [(1, 10102, 8), (1, 10205, 7)]
    s.drop_periods("fact", [102])
    assert rows(store.Store(spark, str(tmp_path)).read("fact")) == [(1, 10102, 8)]
    s.drop_periods("fact", [101])
    assert s.find("fact") is None and s.refresh().find("dim").count() == 2
    store.run(s, [dim(spark, ["z"], "snapshot")], RULES, FOREIGN)
    assert rows(s.read("dim").select("name")) == [("z",)]


def test_empty_batches_and_tables_without_rules(spark, tmp_path):
    s = store.Store(spark, str(tmp_path))
    store.run(s, [dim(spark, ["a"])], RULES, FOREIGN)
    store.run(s, [fact(spark, [])], RULES, FOREIGN)
    assert s.entries()[0] == 1 and s.find("fact") is None
    with pytest.raises(ValueError, match="no rules"):
        store.run(s, [store.Job("other", None)], RULES, FOREIGN)


def test_every_foreign_key_is_checked(spark):
    """One orphan planted behind each constraint of the model; nulls are no orphans."""
    assert sum(len(v) for k, v in schemas.FOREIGN_KEYS.items() if k.startswith("fact")) == 21
    for name, keys in schemas.FOREIGN_KEYS.items():
        table = rules.rules_with(schemas.LOAD_RULES[name], foreign=keys)
        batch = spark.createDataFrame([tuple([1] * len(keys)), tuple([None] * len(keys)), tuple(range(50, 50 + len(keys)))], ", ".join(f"{c} int" for c in keys))
        members = {d: sorted({c for dim, c in keys.values() if dim == d}) for d, _ in keys.values()}
        dims = {d: spark.createDataFrame([tuple([1] * len(c))], ", ".join(f"{x} int" for x in c)) for d, c in members.items()}
        assert [r["violations"] for r in rules.check_foreign(batch, table, dims).collect()] == [1] * len(keys), name
