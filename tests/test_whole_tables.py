"""Gaps and windows of whole tables, without a look at the SQL."""

import datetime

from oracle import SF
from spotlake.plans.queries import QUERIES
from spotlake.plans.views import view


def test_gaps_and_windows_read_all_rows(spark):
    present = {r[0] for r in spark.read.parquet(f"{SF}/orders.parquet").selectExpr("to_date(o_orderdate)").collect()}
    calendar = {datetime.date(1990, 1, 1) + datetime.timedelta(k) for k in range(4383)}
    gaps = {r.day for r in QUERIES["archive_gaps_whole"](spark, SF).collect()}
    assert gaps == calendar - present and gaps and present & calendar
    months = {r.day for r in QUERIES["archive_month_gaps_whole"](spark, SF).collect()}
    assert months == {d.replace(day=1) for d in calendar} - {d.replace(day=1) for d in present}
    windows = {tuple(r) for r in QUERIES["overlapping_windows_whole"](spark, SF).select("day_no", "hour", "kp").collect()}
    assert windows == {tuple(r) for r in view(spark, SF, "solar_versions").select("day_no", "hour", "kp").collect()}
