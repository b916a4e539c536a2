"""Write PLANS.md: formatted physical plans of the headline jobs.

    python tools/explain_plans.py [/root/testdata/sf0.1]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(sf_dir: str) -> None:
    from pyspark.sql import SparkSession

    from headway.operators import tables
    from headway.operators.delays import build_delays
    from headway.operators.forecast import forecast_grid, forecast_summary, score_alerts
    from headway.operators.metrics import ranking_metrics
    from headway.operators.windows import label_windows
    from headway.plans.stages import Stages
    from headway.session import BASE_CONF
    from headway.sources import fixtures as fx

    b = SparkSession.builder.master("local[8]")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    spark = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    st = Stages(spark, sf_dir)
    jobs = {
        "delays (fact table: scan + broadcast weather join)": build_delays(
            fx.incidents_from_events(spark, sf_dir), fx.weather_from_orders(spark, sf_dir), ("station", "date", "hour")),
        "route_daily": tables.route_daily(st.delays, sort=False),
        "network_summary": tables.network_summary(st.delays, sort=False),
        "route_risk_scores (from stored route statistics)": tables.route_risk_from_stats(st.route_stats, sort=False),
        "training windows (stored aggregates + stored p60)": label_windows(st.window_aggregates, st.route_p60),
        "forecast grid": forecast_grid(st.route_risk, st.forecast_weather, st.route_encoder, st.period_encoder),
        "forecast summary": forecast_summary(
            score_alerts(st.grid.withColumn("degradation_prob", st.grid["hour"] / 24.0), sort=False), sort=False),
        "ranking metrics (bucketed running sums)": ranking_metrics(
            st.delays.selectExpr("delay_min % 17 / 17.0 as score", "is_precipitation as label")),
    }
    out = ["# Physical plans of the headline jobs", "",
           f"Generated by `tools/explain_plans.py` over `{sf_dir}` on local[8] with "
           "`explain(mode='formatted')` (AQE may still turn a sort-merge join into a broadcast at run time).", ""]
    for name, df in jobs.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(mode="formatted")
        out += [f"## {name}", "", "```", buf.getvalue().rstrip(), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    st.release()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
