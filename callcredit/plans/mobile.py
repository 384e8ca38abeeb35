"""M3: mobile-app sign-ups credited to the last call in the week before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.dates import month_key, months_back_start, plus_days, ts_lit
from ..operators.joins import band_join
from ..operators.windows import latest_per


def mobile_signups(inputs, as_of, rules: R.Rules = R.DEFAULT_RULES) -> DataFrame:
    bound = months_back_start(as_of, 1)
    su = (inputs["online_user"].where(F.col("date_effective") >= ts_lit(bound))
          .join(inputs["client_dim"], "skp_client")
          .select("id_cuid", "date_effective"))
    calls = (inputs["call_log"]
             .where((F.col("time_of_call_start") >= plus_days(ts_lit(bound), -rules.signup_extra_days))
                    & F.col("cuid").isNotNull())
             .select("cuid", "time_of_call_start", "resource_name"))
    eff, ts = F.col("date_effective"), F.col("time_of_call_start")
    low = plus_days(eff, -rules.signup_band_days)
    j = band_join(calls, su, (F.col("cuid") == F.col("id_cuid")) & ts.between(low, eff),
                  point=ts, low=low, high=eff)
    pick = latest_per(j, ["cuid"], "time_of_call_start", ties=["date_effective", "resource_name"])
    return pick.select(month_key(eff).alias("sign_up_month"), F.col("id_cuid").alias("cuid"),
                       eff.alias("sign_up_date"), F.col("resource_name").alias("username"),
                       ts.alias("call_date"))
