"""Train the interpretable decision trees and store them as rule-tree artifacts.

usage: python scripts/export_rule_trees.py [sf_dir] [out_dir]
Trains stage 1 (attack rate per leaf) and stage 2 (attack family) shallow
trees on the cleaned flows outside the canonical holdout, then writes
``rules_stage1.json`` / ``rules_stage2.json`` and their text renderings.
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowguard.operators import rules as R  # noqa: E402
from flowguard.operators import sampling as SM  # noqa: E402
from flowguard.plans import jobs as J  # noqa: E402
from flowguard.plans.queries import flows_clean  # noqa: E402
from flowguard.session import build_session, cut  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(__file__), "..", "flowguard",
                                                             "resources")
    spark = build_session("local[8]", shuffle_partitions=8,
                          conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="fg-export-")})
    df = flows_clean(spark, sf)
    rest = cut(SM.outside_holdout(df))
    b1, _ = J.train_stage1(rest, family="interpretable")
    t1 = R.tree_from_model(spark, b1.model.stages[-1], J.kept_features(b1), R.PROBABILITY)
    b2, _ = J.train_stage2(rest, family="interpretable")
    t2 = R.tree_from_model(spark, b2.model.stages[-1], J.kept_features(b2), R.CLASS, b2.classes)
    for name, t, thr in (("rules_stage1", t1, b1.threshold), ("rules_stage2", t2, 0.5)):
        t.save(os.path.join(out, name + ".json"))
        with open(os.path.join(out, name + ".txt"), "w", encoding="utf-8") as f:
            f.write(R.to_text(t))
        print(name, "leaves", len(t.leaves()), "depth", t.depth(), "threshold", thr)
    with open(os.path.join(out, "rules_stage1.threshold"), "w") as f:
        f.write(repr(b1.threshold) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
