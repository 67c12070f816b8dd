"""Structure files in mmCIF text: a scan to rows of categories, categories as tables, atoms, assemblies.

Files (plain or gzip) are read as binary rows, one file to a row, and tokenised
into Arrow batches of whole category rows, each a map of its columns: a category
is a projection of them, without a shuffle. Each file also has one row of the
category ``_file``, with what is wrong with it, if anything: a damaged file costs
its own rows and no other's.
"""

from __future__ import annotations

import gzip
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as _Window
from pyspark.sql import functions as F

from helixframe.functions.scalars import is_hydrogen, null_text, number_or_null, operations

ITEMS = "path string, block string, category string, row_idx int, cells map<string,string>, error string"
#: The category of the rows that stand for files.
FILE = "_file"
#: Values of a loop in one batch.
BATCH_VALUES = 1 << 19
_TOKEN = re.compile(r"""'((?:[^'\n]|'(?=\S))*)'(?=\s|$)|"((?:[^"\n]|"(?=\S))*)"(?=\s|$)|(\#[^\n]*)|([^\s'"#][^\s]*)""", re.M)
#: What a line of one name only does not have.
_MORE = re.compile(r"\s")


def _text_value(first: str, lines: Iterator[str], after: list[str]) -> str:
    """The text value that a line with ';' begins; ``after`` gets what follows its end in the line."""
    value = [first[1:]]
    for line in lines:
        if line.startswith(";"):
            after.append(line[1:])
            return "\n".join(value)
        value.append(line)
    raise ValueError("a text value has no end")


def _plain(text: str) -> Iterator[tuple[str, bool]]:
    for m in _TOKEN.finditer(text):
        if m[3] is None:
            yield (m[4], False) if m[4] is not None else (m[1] if m[1] is not None else m[2], True)


def _values(line: str) -> list[str]:
    """The values of a line, quoted or not."""
    if "'" in line or '"' in line or "#" in line:
        return [value for value, _ in _plain(line)]
    return line.split()


def rows(text: str) -> Iterator[tuple[str, str, list[str], list[str]]]:
    """(block, category, columns, values row by row) of each loop, and of the single items of a category as one row.

    A file whose loop has no whole number of rows, that has a value without a
    name, or no block, is no whole one and raises.
    """
    block, names, values, in_loop, name, blocks = "", [], [], False, None, 0
    single: dict[str, dict[str, str]] = {}

    def loop():
        if names and len(values) % len(names):
            raise ValueError(f"a loop of {len(names)} columns from {names[0]} on has {len(values)} values")
        if names and values:
            yield block, names[0].partition(".")[0], [x.partition(".")[2] for x in names], values

    def rest():
        yield from loop()
        for category, cells in single.items():
            yield block, category, list(cells), list(cells.values())
        single.clear()

    def next_of(found):
        nonlocal block, names, values, in_loop, name, blocks
        for value, quoted in found:
            start = "" if quoted else value[:5].lower()
            if start == "data_":
                yield from rest()
                block, names, values, in_loop, name, blocks = value[5:], [], [], False, None, blocks + 1
            elif start == "loop_" and len(value) == 5:
                yield from loop()
                names, values, in_loop, name = [], [], True, None
            elif not quoted and value.startswith("_"):
                if in_loop and not values:
                    names.append(value[1:])
                else:
                    yield from loop()
                    names, values, in_loop, name = [], [], False, value[1:]
            elif in_loop:
                values.append(value)
            elif name is not None:
                category, _, column = name.partition(".")
                single.setdefault(category, {})[column] = value
                name = None

    lines = iter(text.splitlines())
    for line in lines:
        if line.startswith(";"):
            yield from next_of([(_text_value(line, lines, after := []), True)])
            line = after[0]
        # Names and words of the format have a "_": a line of a loop without one has values only, and no token spans lines.
        if in_loop and "_" not in line:
            values += _values(line)
        elif in_loop and not values and line.startswith("_") and not _MORE.search(line):
            names.append(line[1:])
        else:
            yield from next_of(_plain(line))
    yield from rest()
    if not blocks:
        raise ValueError("there is no data block")


_DAMAGE = (OSError, EOFError, zlib.error, ValueError)
_KINDS = [("path", pa.string()), ("block", pa.string()), ("category", pa.string()), ("row_idx", pa.int32()), ("cells", pa.map_(pa.string(), pa.string())), ("error", pa.string())]


class _Held:
    """Rows of any number of files on their way into one batch: an Arrow batch a file and category costs more than its tokens."""

    def __init__(self):
        self.same: list[tuple] = []  # (path, block, category, error) and how many rows have them, the first one's place
        self.ends, self.columns, self.values = [0], [], []

    def add(self, path: str, block: str, category: str, columns: list[str], values: list[str], error: str | None = None) -> Iterator[pa.RecordBatch]:
        wide = len(columns)
        step = max(1, BATCH_VALUES // wide) * wide
        for lo in range(0, len(values), step):
            part = values[lo : lo + step] if len(values) > step else values
            n, first = len(part) // wide, lo // wide
            self.same.append((path, block, category, error, n, first))
            self.ends += range(self.ends[-1] + wide, self.ends[-1] + len(part) + 1, wide)
            self.columns += columns * n
            self.values += part
            if len(self.values) >= BATCH_VALUES:
                yield self.batch()

    def batch(self) -> pa.RecordBatch:
        *texts, count, first = zip(*self.same, strict=True)
        count, first = np.array(count), np.array(first)
        row = np.repeat(np.arange(len(count)), count)
        place = pa.array((np.arange(len(row)) - (np.cumsum(count) - count - first)[row]).astype(np.int32))
        path, block, category, error = (pa.array(x, pa.string()).take(pa.array(row)) for x in texts)
        # Names of columns come again with every row: each is made a text once.
        known = {x: k for k, x in enumerate(dict.fromkeys(self.columns))}
        names = pa.array(list(known), pa.string()).take(pa.array(np.fromiter(map(known.__getitem__, self.columns), np.int32, len(self.columns))))
        cells = pa.MapArray.from_arrays(pa.array(self.ends, pa.int32()), names, pa.array(self.values, pa.string()))
        self.__init__()
        return pa.RecordBatch.from_arrays([path, block, category, place, cells, error], schema=pa.schema(_KINDS))


def _read(batches: Iterator[pa.RecordBatch], only: frozenset[str] | None = None) -> Iterator[pa.RecordBatch]:
    held = _Held()
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            raw, bad = content.as_py(), None
            try:
                text = (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode("utf-8", "replace")
                for block, category, columns, values in rows(text):
                    if only is not None and category not in only:
                        continue
                    yield from held.add(path, block, category, columns, values)
            except _DAMAGE as error:
                bad = f"{type(error).__name__}: {error}"[:4000]
            yield from held.add(path, "", FILE, ["bytes"], [str(len(raw))], bad)
    if held.same:
        yield held.batch()


def scan(spark: SparkSession, path: str, pattern: str = "*.cif*", but: DataFrame | None = None) -> DataFrame:
    """Category rows of all structure files under a path, or several separated by commas, but those of ``but`` (path).

    A file that can't be read, or is no whole structure file, has a row with its
    error, and maybe some rows from before the damage; ``whole`` leaves these out.
    Spark lists no files of no bytes, so these are in no table.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path.split(","))
    files = files.select("path", "content")
    return parsed(files if but is None else files.join(but, "path", "left_anti"))


def parsed(contents: DataFrame, *only: str) -> DataFrame:
    """The scan of files given as rows (path, content); every file is read to its end, and its rows are those of the named categories, if any are."""
    return contents.select("path", "content").mapInArrow(lambda batches: _read(batches, frozenset(only) or None), ITEMS)


def files(found: DataFrame) -> DataFrame:
    """(path, error) of every file of a scan; a null error is a file that was read to its end."""
    return found.where(F.col("category") == FILE).select("path", "error")


def undamaged(rows: DataFrame, found: DataFrame) -> DataFrame:
    """What was made of a scan (with a path), without that of files with an error: the same as of ``whole`` rows, but no cells are shuffled."""
    return rows.join(files(found).where("error is not null").select("path"), "path", "left_anti")


def whole(found: DataFrame) -> DataFrame:
    """Rows of the files without an error."""
    bad = files(found).where("error is not null").select("path")
    good = found.where(F.col("category") != FILE).drop("error")
    return good if bad.isEmpty() else good.join(bad, "path", "left_anti")


def stored(found: DataFrame, target: str) -> DataFrame:
    """Rows written once, a folder for each category: each category that is read later reads its own only."""
    found.write.mode("overwrite").partitionBy("category").parquet(target)
    return found.sparkSession.read.schema(found.schema).parquet(target)


def categories(found: DataFrame, wanted: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Tables of the named categories and columns."""
    return {name: category(found, name, columns) for name, columns in wanted.items()}


def _cells(found: DataFrame, name: str, column: str) -> DataFrame:
    """(path, row_idx, value) of the rows of a category that have a column."""
    value = F.try_element_at("cells", F.lit(column))
    return found.where(F.col("category") == name).select("path", "row_idx", value.alias("value"), F.map_contains_key("cells", column).alias("_has")).where("_has").drop("_has")


def column_values(found: DataFrame, name: str, column: str) -> DataFrame:
    """The values of one column of a category in order, as written."""
    return _cells(found, name, column).groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "value"))), lambda x: x["value"]).alias("values"))


def category(found: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """S3: a category's rows; blank, '.' and '?' are null. A projection: each row has its cells with it.

    Rows with none of the columns are left out.
    """
    rows_of = found.where(F.col("category") == name)
    has = F.exists(F.array(*[F.lit(c) for c in columns]), lambda c: F.map_contains_key("cells", c))
    return rows_of.where(has).select("path", "block", "row_idx", *[null_text(F.try_element_at("cells", F.lit(c))).alias(c) for c in columns])


def first_value(found: DataFrame, name: str, column: str) -> DataFrame:
    """Per file the first value that is not null."""
    known = _cells(found, name, column).select("path", "row_idx", null_text(F.col("value")).alias("value"))
    return known.where("value is not null").groupBy("path").agg(F.min_by("value", "row_idx").alias("value"))


def row_counts(found: DataFrame, name: str, column: str) -> DataFrame:
    """S6."""
    return _cells(found, name, column).groupBy("path").agg(F.count("*").alias("rows"))


_ATOM = ["group_PDB", "type_symbol", "label_atom_id", "label_alt_id", "label_comp_id", "label_asym_id", "label_entity_id", "label_seq_id",
         "auth_seq_id", "pdbx_PDB_ins_code", "auth_asym_id", "Cartn_x", "Cartn_y", "Cartn_z", "occupancy", "pdbx_PDB_model_num"]


def atoms(found: DataFrame, model: int = 1, drop_hydrogens: bool = True) -> DataFrame:
    """Atoms of a model, one alternative location of each residue, without hydrogens and non-finite places."""
    raw = category(found, "atom_site", _ATOM)
    rows = raw.where(F.coalesce(F.col("pdbx_PDB_model_num"), F.lit("1")) == str(model)).select(
        "path", F.col("row_idx").alias("atom_idx"), F.col("label_asym_id").alias("chain_id"), F.col("label_entity_id").alias("entity_id"),
        F.coalesce(F.col("label_seq_id"), F.col("auth_seq_id")).try_cast("int").alias("res_id"), F.col("pdbx_PDB_ins_code").alias("ins_code"),
        F.col("label_comp_id").alias("res_name"), F.col("label_atom_id").alias("atom_name"), F.upper("type_symbol").alias("element"),
        (F.col("group_PDB") == "HETATM").alias("hetero"), F.col("label_alt_id").alias("alt"),
        *[number_or_null(F.col(f"Cartn_{c}")).cast("float").alias(c) for c in "xyz"], F.coalesce(number_or_null(F.col("occupancy")), F.lit(1.0)).alias("occupancy"),
    )
    keep = rows.where("x is not null and y is not null and z is not null")
    if drop_hydrogens:
        keep = keep.where(~is_hydrogen(F.col("element"), F.col("atom_name")))
    residue = ["path", "chain_id", "res_id", "ins_code", "res_name"]
    alts = keep.where("alt is not null").groupBy(*residue, "alt").agg(F.sum("occupancy").alias("o"))
    best = alts.groupBy(*residue).agg(F.max_by("alt", F.struct(F.col("o"), -F.ascii("alt"))).alias("picked"))
    best = best.select(*[F.col(c).alias(f"_{c}") for c in residue], "picked")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in residue]
    joined = keep.where("alt is not null").join(best, same).where("alt = picked")
    # Most atoms have no alternative, and meet none.
    return keep.where("alt is null").drop("alt", "occupancy").unionByName(joined.drop(*[f"_{c}" for c in residue], "alt", "picked", "occupancy"))


def _product(a, b):
    """Two moves (nine numbers of a matrix by rows, three of a shift) as one: the second first."""
    turn = [sum((a[3 * i + k] * b[3 * k + j] for k in range(3)), F.lit(0.0)) for i in range(3) for j in range(3)]
    shift = [sum((a[3 * i + k] * b[9 + k] for k in range(3)), F.lit(0.0)) + a[9 + i] for i in range(3)]
    return F.array(*turn, *shift)


def assembly_atoms(found: DataFrame, assembly_id: str | None, model: int = 1) -> DataFrame:
    """Atoms of an assembly, or of all: each generator's operations applied to its chains, as columns."""
    gen = category(found, "pdbx_struct_assembly_gen", ["assembly_id", "asym_id_list", "oper_expression"])
    gen = gen.where("assembly_id is not null" if assembly_id is None else F.col("assembly_id") == assembly_id)
    # The same few expressions come in most files: each is read once (the outer form, as the plain one has all files read them to see that they are not empty).
    read = gen.select(F.col("oper_expression").alias("_e")).distinct().select("_e", operations(F.col("_e")).alias("ops"))
    steps = gen.join(read, F.col("oper_expression").eqNullSafe(F.col("_e"))).select("path", "assembly_id", "row_idx", "asym_id_list", F.posexplode_outer("ops").alias("place", "op"))
    names = [f"matrix[{i}][{j}]" for i in (1, 2, 3) for j in (1, 2, 3)] + [f"vector[{i}]" for i in (1, 2, 3)]
    oper = category(found, "pdbx_struct_oper_list", ["id", *names]).where("id is not null")
    move = F.array(*[number_or_null(F.col(f"`{n}`")) for n in names])
    known = oper.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("id", move.alias("m")))).alias("known"))
    # A product of operations is applied right to left, however many factors it has.
    factors = F.transform(F.split("op", "x"), lambda x: F.try_element_at("known", x))
    whole = F.aggregate(factors, F.array(*[F.lit(float(i == j)) for i in range(3) for j in range(3)], *[F.lit(0.0)] * 3), _product)
    # Most operations are no products; adding nothing makes -0 what products make of it.
    lone = F.transform(F.try_element_at("known", "op"), lambda x: x + F.lit(0.0))
    moves = steps.join(known, "path").withColumn("m", F.when(F.contains("op", F.lit("x")), whole).otherwise(lone))
    # A move is made once and goes to all chains of its generator.
    chain = F.explode(F.transform(F.split("asym_id_list", ","), lambda x: F.trim(x))).alias("chain_id")
    moves = moves.select("path", "assembly_id", "op", "row_idx", "place", "m", chain).where("m is not null and not exists(m, x -> x is null)")
    moves = moves.select("path", "assembly_id", "op", "row_idx", "chain_id", "place", *[F.col("m")[k].alias(f"m{k}") for k in range(12)])
    copies = moves.withColumn("sym_id", F.dense_rank().over(_Window.partitionBy("path", "assembly_id", "chain_id").orderBy("row_idx", "place")) - 1)
    placed = atoms(found, model).join(copies.drop("row_idx", "place"), ["path", "chain_id"])
    moved = [(F.col(f"m{3 * i}") * F.col("x") + F.col(f"m{3 * i + 1}") * F.col("y") + F.col(f"m{3 * i + 2}") * F.col("z") + F.col(f"m{9 + i}")).cast("float").alias(c) for i, c in enumerate("xyz")]
    kept = [c for c in placed.columns if c not in ("x", "y", "z") and not re.fullmatch(r"m\d+", c)]
    return placed.select(*kept, *moved)
