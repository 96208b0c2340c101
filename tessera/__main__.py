"""python -m tessera VERB FOLDER [--limit N]: prints the rows of the query behind a verb, or of any query by name."""

from __future__ import annotations

import argparse

VERBS = {
    "status": "last_run", "items": "items_by_source", "coverage": "coverage_summary", "alerts": "alerts", "webhook": "webhook_stats", "screen": "screen_report", "extract": "candidate_cap",
    "rank": "top_matters", "etrack": "enrollments", "claims": "claims_vendor_counts", "compliance": "policy_gate", "dashboard": "pipeline_counts", "export": "export_rows",
}


def main(arguments: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    from tessera import queries, queries_access  # noqa: F401

    parser = argparse.ArgumentParser(prog="tessera", description=__doc__)
    parser.add_argument("verb", help=f"{', '.join(VERBS)}, or a query's name")
    parser.add_argument("folder", help="where the tables are, as Parquet")
    parser.add_argument("--limit", type=int, default=20, help="rows to print")
    given = parser.parse_args(arguments)
    name = VERBS.get(given.verb, given.verb)
    if name not in queries.QUERIES:
        parser.error(f"no query {name}")
    queries.QUERIES[name](SparkSession.builder.getOrCreate(), given.folder).show(given.limit, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
