"""python -m pulsegrid run --evidence F --embeddings F --decisions F --narratives F --out D --run-id R --as-of DAY | query NAME SF_DIR | verify FOLDER."""

from __future__ import annotations

import argparse
import sys

from pulsegrid.contracts import ContractError


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pulsegrid")
    commands = parser.add_subparsers(dest="command", required=True)
    whole = commands.add_parser("run", help="a whole run from landed documents")
    for name in ("evidence", "embeddings", "decisions", "narratives", "out", "run-id", "as-of"):
        whole.add_argument(f"--{name}", required=True)
    whole.add_argument("--project", default="en.wikipedia")
    whole.add_argument("--threshold", type=float, default=0.76)
    whole.add_argument("--review-cap", default="10")
    one = commands.add_parser("query", help="show a query over the test data")
    one.add_argument("name")
    one.add_argument("sf_dir")
    commands.add_parser("verify", help="check a published folder").add_argument("folder")
    a = parser.parse_args(argv)
    try:
        if a.command == "verify":
            from pulsegrid.operators.publish import verify

            verify(a.folder)
            return 0
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
        if a.command == "query":
            from pulsegrid.plans.catalogue import queries

            queries()[a.name](spark, a.sf_dir).show(50, truncate=80)
            return 0
        from pulsegrid.plans.run import run

        inputs = {k: getattr(a, k) for k in ("evidence", "embeddings", "decisions", "narratives")}
        print(run(spark, inputs, a.out, a.run_id, a.as_of, a.project, a.threshold, a.review_cap, lines=sys.stderr))
        return 0
    except ContractError as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
