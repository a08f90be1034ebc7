"""Property tests against brute force on small random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from settlekit.operators.promote import latest_per_key, merge_lookback
from settlekit.operators.reconcile import current_latest_nonnull

SCHEMA = "transaction_id string, state string, reason string, updated_at timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d"]),
              st.one_of(st.none(), st.sampled_from(["authorized", "settled", "failed"])),
              st.one_of(st.none(), st.sampled_from(["fraud_suspected", "technical_error"])),
              st.integers(0, 5000)),        # distinct seconds below: no ties on updated_at per key
    min_size=1, max_size=25, unique_by=lambda r: (r[0], r[3]))

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _df(spark, rows):
    return spark.createDataFrame([(k, s, r, T0 + dt.timedelta(seconds=t)) for k, s, r, t in rows], SCHEMA)


@SETTINGS
@given(rows=rows_strategy)
def test_current_state_is_latest_non_null_per_column(spark, rows):
    got = {r["transaction_id"]: (r["state"], r["reason"], r["updated_at"])
           for r in current_latest_nonnull(_df(spark, rows)).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        versions = sorted((r for r in rows if r[0] == key), key=lambda r: r[3])
        state = next((r[1] for r in reversed(versions) if r[1] is not None), None)
        reason = next((r[2] for r in reversed(versions) if r[2] is not None), None)
        want[key] = (state, reason, T0 + dt.timedelta(seconds=versions[-1][3]))
    assert got == want


@SETTINGS
@given(rows=rows_strategy, cutoff=st.integers(0, 5000), lookback=st.integers(0, 2000))
def test_lookback_merge_equals_full_rebuild_when_changes_are_in_the_window(spark, rows, cutoff, lookback):
    df = _df(spark, rows)
    start = T0 + dt.timedelta(seconds=cutoff - lookback)
    cut = T0 + dt.timedelta(seconds=cutoff)
    old = latest_per_key(df.filter(df.updated_at < cut))
    merged = merge_lookback(old, df.filter(df.updated_at >= start))
    full = latest_per_key(df)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, full.collect()))
