"""Files that a run leaves: JSON, CSV, JSON lines, Parquet, FASTA, PDB and an HTML report."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.scalars import html_text


def json_lines(rows: DataFrame, target: str) -> None:
    """A JSON object a row; nulls stay as fields."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(target)


def json_documents(rows: DataFrame, key: str, target: str) -> None:
    """One gzip document for each value of a key, in a folder of the key's name."""
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != key]), {"ignoreNullFields": "false"})
    out = rows.select(F.col(key), body.alias("value"))
    out.repartition(key).write.mode("overwrite").option("compression", "gzip").partitionBy(key).text(target)


def csv_rows(rows: DataFrame, target: str, first: list[str] | None = None) -> None:
    """Rows as CSV with a header; preferred columns that exist come first, nested values as JSON."""
    order = [c for c in first or [] if c in rows.columns]
    order += [c for c in rows.columns if c not in order]
    kinds = dict(rows.dtypes)
    flat = [F.to_json(F.col(f"`{c}`")).alias(c) if kinds[c].startswith(("array", "struct", "map")) else F.col(f"`{c}`") for c in order]
    rows.select(*flat).write.mode("overwrite").option("header", "true").option("emptyValue", "").option("escape", '"').csv(target)


#: Columns that come first in the table of cases.
CASE_COLUMNS = [
    "case_id", "pdb_id", "input_path", "status", "experimental_method", "resolution", "release_date", "num_chains", "num_polymer_chains", "num_asym_ids", "num_dimers",
    "num_multimers", "num_antibody_antigen_complexes", "num_tcr_pmhc_complexes", "num_assemblies", "num_assemblies_processed", "warning_code",
]


def parquet(rows: DataFrame, target: str) -> None:
    """Parquet with zstd of level 3; a table without rows keeps its columns."""
    rows.write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3").parquet(target)


def fasta_records(monomers: DataFrame, width: int = 80) -> DataFrame:
    """(polymer_class, monomer_id, record) of sequences in lines of a width; component names are no sequence."""
    lines = F.regexp_replace("sequence", f"(.{{{width}}})", "$1\n")
    body = F.regexp_replace(F.concat(F.lit(">"), "monomer_id", F.lit("\n"), lines), "\n$", "")
    return monomers.where("polymer_class is not null and polymer_class <> 'other_polymer'").select("polymer_class", "monomer_id", body.alias("record"))


def fasta(monomers: DataFrame, target: str) -> None:
    """A folder of FASTA files for each polymer class, in order of ids: part files follow one another."""
    rows = fasta_records(monomers).repartitionByRange("polymer_class", "monomer_id").sortWithinPartitions("polymer_class", "monomer_id")
    rows.select("polymer_class", F.col("record").alias("value")).write.mode("overwrite").partitionBy("polymer_class").text(target)


#: Names for chains in PDB files.
PDB_CHAINS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def pdb_atoms(atoms: DataFrame) -> DataFrame:
    """Atoms as they go into a PDB file: no hetero flag, long names as UNK, chains renamed in order.

    ``atoms`` has structure, part (place of its chain), atom_idx, res_id,
    ins_code, res_name, atom_name, element, x, y, z.
    """
    name = F.when(F.length("res_name") > 3, "UNK").otherwise(F.col("res_name"))
    too_many = F.raise_error(F.concat(F.lit("more chains than a PDB file can name in "), F.col("structure").cast("string"))).cast("string")
    chain = F.when(F.col("part") < len(PDB_CHAINS), F.substring(F.lit(PDB_CHAINS), F.col("part").cast("int") + 1, F.lit(1))).otherwise(too_many)
    return atoms.withColumns({"res_name": name, "pdb_chain": chain, "hetero": F.lit(False)})


def pdb_line() -> Column:
    """One ATOM record in fixed columns."""
    atom = F.when((F.length("atom_name") < 4) & (F.length(F.coalesce("element", F.lit(""))) < 2), F.concat(F.lit(" "), F.rpad("atom_name", 3, " "))).otherwise(F.rpad("atom_name", 4, " "))
    return F.format_string(
        "ATOM  %5d %s %3s %s%4d%1s   %8.3f%8.3f%8.3f%6.2f%6.2f          %2s", F.col("serial") % 100000, atom, F.col("res_name"), F.col("pdb_chain"), F.col("res_id") % 10000,
        F.coalesce(F.nullif(F.trim(F.coalesce("ins_code", F.lit(""))), F.lit("")), F.lit(" ")), F.col("x").cast("double"), F.col("y").cast("double"), F.col("z").cast("double"), F.lit(1.0), F.lit(0.0), F.upper(F.coalesce("element", F.lit(""))),
    )


def pdb_documents(atoms: DataFrame) -> DataFrame:
    """(structure, document) of PDB files, a TER after each chain; ``atoms`` as of ``pdb_atoms``."""
    from pyspark.sql import Window

    w = Window.partitionBy("structure").orderBy("part", "atom_idx")
    rows = atoms.withColumn("serial", F.row_number().over(w))
    chains = rows.groupBy("structure", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("serial", pdb_line().alias("l")))), lambda x: x["l"]), "\n").alias("body"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("part", "body"))), lambda x: F.concat(x["body"], F.lit("\nTER\n")))
    return chains.groupBy("structure").agg(F.concat(F.array_join(parts, ""), F.lit("END\n")).alias("document"))


def short_chains(atoms: DataFrame, least: int = 3) -> DataFrame:
    """Chains with fewer residues than an alignment needs."""
    n = atoms.select("structure", "part", "res_id", F.coalesce("ins_code", F.lit("")).alias("i")).distinct().groupBy("structure", "part").agg(F.count("*").alias("residues"))
    return n.where(F.col("residues") < least)


def html_table(title: str, rows: pd.DataFrame, limit: int = 100) -> str:
    """An escaped table of a report; its first ``limit`` rows (a report's own limit), and how many there are."""
    import html

    say = lambda v: html.escape("" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v), quote=True)
    head = "".join(f"<th>{say(c)}</th>" for c in rows.columns)
    body = "".join("<tr>" + "".join(f"<td>{say(v)}</td>" for v in r) + "</tr>" for r in rows.head(limit).itertuples(index=False))
    more = f"<p>{len(rows) - limit} more rows</p>" if len(rows) > limit else ""
    return f"<section><h2>{say(title)}</h2><table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>{more}</section>"


def html_report(title: str, tables: dict[str, DataFrame], limit: int = 100) -> str:
    """A page of a review's tables; of each table one row more than shown is fetched, and its count."""
    parts = []
    for name, rows in tables.items():
        shown = rows.limit(limit).toPandas()
        n = rows.count()
        parts.append(html_table(f"{name} ({n})", shown, limit))
    import html

    return f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{''.join(parts)}</body></html>"


def html_cell(c: Column) -> Column:
    """Numbers to four significant places as text, everything escaped."""
    return html_text(c)
