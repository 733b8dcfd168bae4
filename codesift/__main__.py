"""``python -m codesift JOB ...``, or through spark-submit with this package.

    mine ROOT OUT              repositories below ROOT to a mined table
    explore [--base --mined]   class and CWE distributions
    train MODELS [--base --mined --small]
    evaluate MODELS
    scan ROOT MODELS OUT       files below ROOT to a scan report
    report OUT                 tables of a stored scan report
    analyze [--base --mined]   learning curves of both kinds of models
    explain MODELS
    drift MODELS [--results OUT]
"""

from __future__ import annotations

import argparse

from codesift.plans import jobs, training
from codesift.session import build_session, ship_package
from codesift.sources import scan_reports

SMALL_GRID = [{"trees": 20, "depth": 8, "min_split": 2, "class_weight": w}
              for w in ("balanced", None)]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="codesift", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["mine", "explore", "train", "evaluate", "scan", "report",
                                        "analyze", "explain", "drift"])
    parser.add_argument("paths", nargs="*")
    parser.add_argument("--base")
    parser.add_argument("--mined")
    parser.add_argument("--functions", help="external function table (CSV)")
    parser.add_argument("--patches", help="external patch table (CSV)")
    parser.add_argument("--results")
    parser.add_argument("--small", action="store_true", help="two settings, not the full grid")
    parser.add_argument("--master", help="for local runs, e.g. local[8]")
    args = parser.parse_args(arguments)
    spark = build_session("codesift", args.master)
    ship_package(spark)

    def samples():
        return jobs.load(spark, args.base, args.mined, function_path=args.functions,
                         patch_path=args.patches)

    def analyzed():
        train_rows, test_rows, _, _ = training.split_features(samples(), "row_id")
        tables = jobs.training_analysis(train_rows, test_rows.select(*train_rows.columns))
        return {f"{model}: {name}": t for model, found in tables.items() for name, t in found.items()}

    run = {
        "mine": lambda root, out: jobs.mine(spark, root, out),
        "explore": lambda: jobs.explore(samples()),
        "train": lambda models: jobs.train(samples(), models, SMALL_GRID if args.small else None),
        "evaluate": lambda models: jobs.evaluate(spark, models),
        "scan": lambda root, models, out: jobs.scan(spark, root, models, out),
        "report": lambda out: jobs.report_tables(scan_reports.read_results(spark, out)),
        "analyze": analyzed,
        "explain": lambda models: jobs.explain(spark, models),
        "drift": lambda models: jobs.drift(spark, models, args.results),
    }
    for name, table in run[args.job](*args.paths).items():
        print(f"\n{name}")
        table.show(20, truncate=60)


if __name__ == "__main__":
    main()
