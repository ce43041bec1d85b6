"""Where results go."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_results(df: DataFrame, path: str) -> None:
    """Parquet with a folder for each target."""
    df.write.mode("overwrite").partitionBy("target_gene").parquet(path)


def write_result_csv(df: DataFrame, outdir: str, target: str, quoted: bool = True) -> None:
    """One target's result as CSV in order of gene, nulls as NA, without row names."""
    rows = df.filter(df.target_gene == target).orderBy("gene_ID")
    _csv(rows, f"{outdir}/pert_{target}_de_res_df.csv", quoted)


def write_metadata_csv(cells: DataFrame, outdir: str, target: str, quoted: bool = True) -> None:
    """Cells with all their columns, cell_id first."""
    _csv(cells.select("cell_id", *(c for c in cells.columns if c != "cell_id")).orderBy("cell_id"), f"{outdir}/pert_{target}_meta_data.csv", quoted)


def _csv(df: DataFrame, path: str, quoted: bool) -> None:
    options = {"header": True, "nullValue": "NA", "emptyValue": ""} | ({} if quoted else {"quote": ""})
    df.coalesce(1).write.mode("overwrite").options(**options).csv(path)
