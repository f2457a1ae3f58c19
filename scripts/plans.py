"""Write the physical plans of the key operators to PLANS.md (sf0.01 by default).

Usage: python scripts/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


from lodestar.operators import rank as R  # noqa: E402
from lodestar.operators.sorting import positions  # noqa: E402
from lodestar.plans import ml_queries as MQ  # noqa: E402
from lodestar.plans.graphs import supply_edges  # noqa: E402
from lodestar.plans.sort_queries import SORT_KEYS, orders_as_text  # noqa: E402
from lodestar.session import checkpoint_dir, get_session  # noqa: E402


def plan(df) -> str:
    jvm = df.sparkSession._jvm
    return df._jdf.queryExecution().explainString(
        jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")).strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    checkpoint_dir(spark)
    out = ["# Physical plans of the key operators",
           "",
           f"Generated by `python scripts/plans.py` on `{os.path.basename(sf)}` (local[8], AQE on; the initial",
           "plan is shown, AQE may still coalesce partitions or switch a join to broadcast at run time).",
           "Broadcast joins of base tables are Spark's own size-checked choice (`autoBroadcastJoinThreshold`);",
           "at scale the same joins plan as shuffled joins with AQE skew splitting.", ""]
    prep = R.prepare_links(supply_edges(spark, sf), dedupe=False)
    cases = [
        ("Supply graph: only the four key columns are scanned; pairs are de-duplicated with a partial aggregate",
         supply_edges(spark, sf)),
        ("One rank round: the bucketed links are scanned with no exchange; only the shares and the sums shuffle",
         R.rank_round(prep, R.initial_ranks(prep))),
        ("Top-k report: TakeOrderedAndProject, no global sort",
         R.top_ranks(R.initial_ranks(prep).select("id", "rank"), 5)),
        ("Global sort by string keys: range exchange + sort; positions join a one-row-per-partition table",
         positions(orders_as_text(spark, sf), SORT_KEYS)),
        ("Scoring: Arrow-batched numpy over the pruned feature scan",
         MQ.LIN.linear_scores(MQ.features(spark, sf), MQ.LIN.Model.zeros(64, 10))),
        ("Array functions stay in the JVM (higher-order functions, per-row constants outside lambdas)",
         MQ.features(spark, sf).select("id", MQ.A.standardize("features").alias("z"))),
    ]
    for title, df in cases:
        out += [f"## {title}", "", "```", plan(df), "```", ""]
    prep.release()
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print("wrote", path)


if __name__ == "__main__":
    main()
