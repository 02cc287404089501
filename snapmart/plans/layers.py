"""Bronze, silver and gold layers, written stage by stage."""

from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapmart.operators.clean import FINANCIAL_SPECS, clean_contract, clean_demographic, clean_financial, clean_service
from snapmart.operators.formats import elect_format
from snapmart.operators.fuzzy import DEMOGRAPHIC_SPECS
from snapmart.operators.lookup import staged_lookup
from snapmart.operators.rows import dedup_report, keep_unique, normalize_headers, normalize_key, parse_snapshot_date
from snapmart.plans.gold import gold_snapshot
from snapmart.sources.fits import Fits
from snapmart.sources.ledger import Ledger
from snapmart.sources.layers import layer_path, overwrite_snapshots, write_snapshots

#: Cleaners by table, called with the rows and the format of their dates.
CLEANERS = {"demographic": lambda df, fmt: clean_demographic(df, fmt=fmt), "financial": lambda df, fmt: clean_financial(df, order="ord_"),
            "contract": lambda df, fmt: clean_contract(df, fmt=fmt), "service": lambda df, fmt: clean_service(df, fmt=fmt)}


def write_labels(labels: DataFrame, seen=lambda rows: rows, *, root: str, rejected: Observation | None = None) -> None:
    """Labels by snapshot date, read in the elected format; a table all of whose rows are rejected is an error.

    ``seen`` may observe the rows that are written, once.
    """
    fmt = elect_format(labels, order="ord_")
    if parse_snapshot_date(labels, fmt=fmt).isEmpty() and not labels.isEmpty():
        raise ValueError("no snapshot date of the label table can be read")
    write_snapshots(parse_snapshot_date(seen(labels), fmt=fmt, rejected=rejected), layer_path(root, "bronze", "label"))


def run_bronze(spark: SparkSession, inputs: dict[str, DataFrame], root: str) -> Observation:
    """Labels by snapshot date (rejected rows are counted on the way), features unchanged."""
    rejected = Observation("rejected_labels")
    write_labels(inputs["label"], root=root, rejected=rejected)
    for name, df in inputs.items():
        if name != "label":
            df.write.mode("overwrite").parquet(layer_path(root, "bronze", name))
    return rejected


def clean_table(spark: SparkSession, root: str, name: str, fingerprint: str | None = None) -> None:
    """One cleaned table; a feature table's dates are read in the format elected over that table.

    With the ``fingerprint`` of the raw table, fits are kept beside the layers: the dictionary of categories grows by the texts that it has
    not, and fences are fitted once for each state of the table.
    """
    raw = spark.read.parquet(layer_path(root, "bronze", name))
    fits = Fits(spark, f"{root.rstrip('/')}/fits")
    if name == "label":
        write_snapshots(raw, layer_path(root, "silver", name))
    elif fingerprint and name in ("demographic", "financial"):
        df = normalize_headers(raw)
        if name == "demographic":
            cleaned = clean_demographic(df, fmt=elect_format(df, order="ord_"), dictionary=fits.grow(normalize_key(df, "customerID"), DEMOGRAPHIC_SPECS))
        else:
            cleaned = clean_financial(df, order="ord_", fences=fits.fences(df, FINANCIAL_SPECS, fingerprint))
        cleaned.write.mode("overwrite").parquet(layer_path(root, "silver", name))
    else:
        CLEANERS[name](raw, elect_format(normalize_headers(raw), order="ord_")).write.mode("overwrite").parquet(layer_path(root, "silver", name))


def run_silver(spark: SparkSession, root: str, names) -> None:
    for name in names:
        clean_table(spark, root, name)


def run_gold(spark: SparkSession, root: str, names) -> None:
    tables = {n: spark.read.parquet(layer_path(root, "silver", n)) for n in names}
    labels = tables.pop("label")
    write_snapshots(gold_snapshot(labels, tables), layer_path(root, "gold", "gold"))


def run_layers(spark: SparkSession, inputs: dict[str, DataFrame], root: str) -> Observation:
    """All three stages over the tables in ``inputs`` (``label`` and any feature tables)."""
    names = list(inputs)
    rejected = run_bronze(spark, inputs, root)
    run_silver(spark, root, names)
    run_gold(spark, root, names)
    return rejected


def run_ledgered_layers(spark: SparkSession, inputs: dict[str, DataFrame], root: str) -> str:
    """All three stages, each table only where its inputs have changed since the ledger's entry; returns the gold table's fingerprint.

    A changed table is ingested and cleaned again, and gold joined again; the other tables stay as they are.
    """
    ledger = Ledger(spark, root)
    cleaned: list[str] = []
    for name, df in inputs.items():
        bronze, silver = layer_path(root, "bronze", name), layer_path(root, "silver", name)
        write = partial(write_labels, root=root) if name == "label" else lambda rows, seen, path=bronze: seen(rows).write.mode("overwrite").parquet(path)
        raw = ledger.ingest(f"bronze/{name}", df, bronze, write)
        cleaned.append(ledger.step(f"silver/{name}", [raw], partial(ledger.rows, bronze), silver, partial(clean_table, spark, root, name, raw)))
    labels = layer_path(root, "silver", "label")
    return ledger.step("gold/gold", cleaned, partial(ledger.rows, labels), layer_path(root, "gold", "gold"), partial(run_gold, spark, root, list(inputs)))


def run_gold_dedup(spark: SparkSession, root: str, key: str = "customerID", snap: str = "snapdate") -> DataFrame:
    """Keeps the customers that occur once in each gold snapshot, in place; returns the report by date.

    Only dates with repeated customers are written again, from a copy in the shared folder.
    """
    path = layer_path(root, "gold", "gold")
    report = staged_lookup(dedup_report(spark.read.parquet(path), snap, key))
    dirty = report.filter("dropped > 0").select(snap)
    gold = spark.read.parquet(path)
    kept = staged_lookup(keep_unique(gold.join(dirty, snap, "left_semi").select(*gold.columns), [key, snap]))
    if not kept.isEmpty():
        overwrite_snapshots(kept, path)
    return report


def layer_row_counts(spark: SparkSession, root: str, names) -> DataFrame:
    """(layer, table, n) of everything written; the counts come from file footers."""
    tables = [(layer, n) for layer in ("bronze", "silver") for n in names] + [("gold", "gold")]
    counts = [
        spark.read.parquet(layer_path(root, layer, n)).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(layer).alias("layer"), F.lit(n).alias("table"), "n") for layer, n in tables]
    return reduce(DataFrame.unionByName, counts)
