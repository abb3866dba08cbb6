"""Property checks of the load rewrites against a plain-Python model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import loading

SCHEMA = "id bigint, g string, v int"
rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["a", "b", None]),
                             st.integers(0, 9)), max_size=12)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def bag(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def model_merge(target, source):
    keys = {s[0] for s in source if s[0] is not None}
    return [t for t in target if t[0] is None or t[0] not in keys] + list(source)


def model_replace(target, source, g):
    return [t for t in target if t[1] != g] + [s for s in source if s[1] == g]


@SETTINGS
@given(rows_st, rows_st)
def test_merge_matches_model_and_replays(spark, target, source):
    keyed = {}
    source = [s for s in source if s[0] is None or keyed.setdefault(s[0], s) is s]  # payload keys unique
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    once = loading.merge_pk(t, s, "id")
    assert bag([tuple(r) for r in once.collect()]) == bag(model_merge(target, source))
    twice = loading.merge_pk(once, s, "id")
    got_twice = bag([tuple(r) for r in twice.collect()])
    want_twice = bag(model_merge(model_merge(target, source), source))
    assert got_twice == want_twice


@SETTINGS
@given(rows_st, rows_st)
def test_replace_where_matches_model_and_is_idempotent(spark, target, source):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    once = loading.replace_where(t, s, "g = 'a'")
    got = bag([tuple(r) for r in once.collect()])
    assert got == bag(model_replace(target, source, "a"))
    assert bag([tuple(r) for r in loading.replace_where(once, s, "g = 'a'").collect()]) == got
