"""Command line: ``spark-submit`` this package with one of the steps of the pipeline or the table step."""

import argparse

from saleslake.functions.dates import DATE_FORMATS
from saleslake.plans.jobs import run_bronze, run_gold, run_silver
from saleslake.schemas import BRONZE_STORED, GOLD, SILVER_STORED
from saleslake.session import builder
from saleslake.sources.tables import preview, register_rates_table, register_table

LAYERS = {"bronze": BRONZE_STORED, "silver": SILVER_STORED, "gold": GOLD}


def main() -> None:
    parser = argparse.ArgumentParser(prog="saleslake", description=__doc__)
    parser.add_argument("--audit", help="folder for the audit table; next to the target if not given")
    steps = parser.add_subparsers(dest="step", required=True)
    bronze = steps.add_parser("bronze", help="workbooks to bronze")
    silver = steps.add_parser("silver", help="bronze to silver")
    gold = steps.add_parser("gold", help="silver to gold")
    for step in (bronze, silver, gold):
        step.add_argument("source")
        step.add_argument("target")
    bronze.add_argument(
        "--date-format",
        action="append",
        help="format of date texts, may be repeated; ISO dates if not given",
    )
    silver.add_argument("--rates", required=True, help="exchange-rate CSV")
    silver.add_argument("--fill", choices=["none", "calendar"], default="none")
    gold.add_argument("--scope", choices=["chain", "partition"], default="chain")
    table = steps.add_parser("table", help="catalog table over a layer or a folder of rates files")
    table.add_argument("layer", choices=[*LAYERS, "rates"])
    table.add_argument("root")
    table.add_argument("--database", help="saleslake_<layer> if not given")
    table.add_argument("--name", default="ventas")
    args = parser.parse_args()

    spark = builder(f"saleslake-{args.step}").getOrCreate()
    if args.step == "table":
        database = args.database or f"saleslake_{args.layer}"
        if args.layer == "rates":
            name = register_rates_table(spark, database, args.name, args.root)
        else:
            name = register_table(spark, database, args.name, LAYERS[args.layer], args.root)
        print(f"table: {name}")
        preview(spark, name).show()
        return
    if args.step == "bronze":
        formats = args.date_format or DATE_FORMATS
        audit = run_bronze(spark, args.source, args.target, formats)
    elif args.step == "silver":
        audit = run_silver(spark, args.source, args.rates, args.target, args.fill)
    else:
        audit = run_gold(spark, args.source, args.target, args.scope)
    folder = args.audit or f"{args.target.rstrip('/')}_audit/{args.step}"
    audit.write.mode("append").parquet(folder)
    print(f"audit: {folder}")
    audit.groupBy("status").count().show()


if __name__ == "__main__":
    main()
