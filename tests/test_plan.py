"""Plan shape of the whole job: one shuffle on the trip key, dimension joins broadcast."""

from lineweave import build_line_net
from lineweave import fixtures as fx
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_trip_shuffle_and_broadcast_dimensions(spark):
    for mode in ("bridge", "exact"):
        df = build_line_net(fx.grid_trips(spark, SF001), fx.grid_line_stations(spark, SF001),
                            fx.grid_locations(spark, SF001), gap_mode=mode, key_cols=fx.GRID_KEY)
        plan = _plan(df)
        # the dimensions are cached (InMemoryRelation) and broadcast; the trip side has one exchange
        trip_side = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln and "trip_id" in ln]
        assert len(trip_side) == 1, plan
        assert "SortMergeJoin" not in plan
        assert plan.count("BroadcastHashJoin") >= 3
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
