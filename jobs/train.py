"""Train one model on a table and save it with its metrics.

    spark-submit jobs/train.py --task classification --model random_forest \\
        --input table.csv --id id --target churn --numeric a,b --nominal c --output-dir out
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tablework.functions.semantics import is_numeric  # noqa: E402
from tablework.ml import models  # noqa: E402
from tablework.ml.preprocess import TENURE_BUCKETS, Preprocessor, engineer_features  # noqa: E402

log = logging.getLogger("train")


def parse(argv):
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--task", choices=["classification", "regression"], required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--input", required=True, help="CSV with a header, or a Parquet table")
    p.add_argument("--output-dir", required=True)
    p.add_argument("--id", required=True)
    p.add_argument("--target", required=True)
    names = lambda text: [n for n in text.split(",") if n]
    p.add_argument("--numeric", type=names, default=[])
    p.add_argument("--nominal", type=names, default=[])
    p.add_argument("--ordinal", action="append", default=[], metavar="COLUMN=LOWEST,...,HIGHEST",
                   help="column whose levels are coded by their order; may be repeated")
    p.add_argument("--tenure", help="months of stay; with --monthly and --total, four features are derived from the three")
    p.add_argument("--monthly")
    p.add_argument("--total")
    p.add_argument("--scaler", default="standard")
    p.add_argument("--trees", type=int, default=200)
    return p.parse_args(argv)


def binary_target(table, column):
    """The target as 0/1: numbers stay, yes and no (any case, padded) become 1 and 0, other values are an error."""
    if is_numeric(table.schema[column].dataType):
        return table
    text = F.lower(F.trim(F.col(column).cast("string")))
    odd = table.filter(~text.isin("yes", "no")).select(column).limit(1).collect()
    if odd:
        raise ValueError(f"{column} must hold numbers or yes and no, not {odd[0][0]!r}")
    return table.withColumn(column, (text == "yes").cast("int"))  # a missing target stays missing, and fitting counts it


def main(argv=None) -> int:
    args = parse(argv)
    ordinal = {c: levels.split(",") for c, levels in (o.split("=", 1) for o in args.ordinal)}
    derived = (args.tenure, args.monthly, args.total)
    if any(derived) and not all(derived):
        log.error("--tenure, --monthly and --total go together")
        return 2
    known = models.CLASSIFIERS if args.task == "classification" else models.REGRESSORS
    if args.model not in known:
        log.error("unknown model %r for %s; choose one of %s", args.model, args.task, known)
        return 2
    spark = SparkSession.builder.appName("train").getOrCreate()
    if args.input.endswith(".parquet"):
        table = spark.read.parquet(args.input)
    else:
        table = spark.read.option("header", True).option("inferSchema", True).csv(args.input)
    table = table.withColumns({c: F.trim(F.col(c).cast("string")).try_cast("double") for c in args.numeric})
    if args.task == "classification":
        table = binary_target(table, args.target)
    engineer = None
    if all(derived):
        engineer = lambda d: engineer_features(d, *derived)
        args.numeric += ["tenure_years", "avg_monthly_spend", "monthly_charge_x_tenure"]
        ordinal["tenure_bucket"] = TENURE_BUCKETS
    preprocessor = Preprocessor(args.numeric, args.nominal, ordinal, args.scaler)
    data = models.experiment_data(table, args.id, args.target, args.task, preprocessor, engineer)
    metrics = models.train_and_save(data, args.target, args.model, args.output_dir, trees=args.trees)
    log.info("metrics: %s", json.dumps(metrics))
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
