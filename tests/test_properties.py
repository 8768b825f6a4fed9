"""Randomised properties."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators import detect, keyed
from headway.plans import marts
from headway.sources import enriched

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@few
@given(st.lists(st.integers(0, 60), max_size=40))
def test_cooldown_fold_equals_its_step(spark, minutes):
    windows = sorted({60 * m for m in minutes})
    (batch,) = spark.range(1).select(detect.cooldown_fold(F.array(*[F.lit(w).cast("long") for w in windows]).cast("array<bigint>"))).first()
    out, state = [], (0, None, None)
    for w in windows:
        fires, *state = detect.cooldown_step(*state, w)
        out += [w] * fires
    assert batch == out


@few
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 50), st.integers(1, 9)), min_size=1, max_size=30), st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]))
def test_histogram_percentile_equals_that_of_the_rows(spark, rows, p):
    h = spark.createDataFrame(rows, "g string, v int, n int")
    written_out = {r.g: r.value for r in marts.histogram_percentile(h, ["g"], "v", "n", p).collect()}
    expanded = h.select("g", F.explode(F.array_repeat("v", F.col("n"))).alias("v"))
    plain = {r.g: r.q for r in expanded.groupBy("g").agg(F.percentile("v", F.lit(p)).alias("q")).collect()}
    assert written_out.keys() == plain.keys() and all(abs(written_out[g] - plain[g]) < 1e-9 for g in plain)


@few
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 2))), max_size=30))
def test_dedupe_keeps_changes_only(spark, rows):
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(rows)], "k int, i int, v int")
    found = sorted(r.i for r in keyed.value_dedupe(df, ["k"], ["i"], ["v"]).collect())
    last, want = {}, []
    for i, (k, v) in enumerate(rows):
        if k not in last or last[k] != v:
            want.append(i)
        last[k] = v
    assert found == want


@settings(max_examples=200, deadline=None)
@given(st.fixed_dictionaries({}, optional={n: {"string": st.text(max_size=8), "double": st.floats(allow_nan=False), "int": st.integers(-(2**31), 2**31 - 1), "long": st.integers(-(2**63), 2**63 - 1)}[k] for n, k, _ in enriched.FIELDS.values()}))
def test_wire_round_trip(record):
    back = enriched.decoded(enriched.encoded(record, 9))
    for name, kind, present in enriched.FIELDS.values():
        want = record.get(name) if present else record.get(name, enriched._ABSENT[kind])
        assert back[name] == want
