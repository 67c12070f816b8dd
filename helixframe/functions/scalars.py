"""Column expressions over text values: identifiers, dates, classes, expressions of operations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from helixframe.functions import fixed as X


def null_text(c: Column) -> Column:
    """blank, '.' and '?' are null; other values are trimmed."""
    t = F.trim(c)
    return F.when(~t.isin("", ".", "?"), t)


def number_or_null(c: Column) -> Column:
    """A finite number, or null."""
    v = F.expr(f"try_cast({_name(c)} as double)") if isinstance(c, str) else c.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def _name(c: str) -> str:
    return f"`{c}`"


def strict_date(c: Column) -> Column:
    """a date written as YYYY-MM-DD and nothing else, or null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def date_decision(value: Column, cutoff: Column) -> Column:
    """kept before the cutoff; otherwise the reason why not."""
    d = strict_date(value)
    blank = value.isNull() | (F.trim(value) == "")
    return (
        F.when(cutoff.isNull(), "kept").when(blank, "missing").when(d.isNull(), "invalid")
        .when(d < cutoff, "kept").otherwise("too_recent")
    )


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def case_id(path: Column) -> Column:
    """Lower-case file name without its structure suffixes."""
    return F.regexp_replace(F.lower(base_name(path)), r"\.b?cif(\.gz)?$", "")


def entry_from_name(path: Column) -> Column:
    """A four-character entry id that starts the file name, or null."""
    return F.nullif(F.regexp_extract(case_id(path), r"^([0-9][a-z0-9]{3})(?:[-_].*)?$", 1), F.lit(""))


def entry_id(declared: Column, path: Column) -> Column:
    """The declared id in lower case unless a placeholder, else that of the file name, else its stem."""
    d = F.lower(null_text(declared))
    return F.coalesce(F.when(~d.isin("xxxx", "unknown", "none"), d), entry_from_name(path), case_id(path))


def assembly_from_name(path: Column) -> Column:
    """The letters and digits after 'assembly' in a file name, where it starts a part of the name; or null."""
    return F.nullif(F.regexp_extract(case_id(path), r"(?:^|[-_])assembly[-_]?([a-z0-9]+)(?:$|[-_])", 1), F.lit(""))


def entry_from_assembly(path: Column) -> Column:
    """The entry before '-assembly' or '_assembly' in a file name: four characters in upper case."""
    return F.substring(F.upper(F.regexp_replace(case_id(path), r"[-_]assembly.*$", "")), 1, 4)


def shard_group(path: Column) -> Column:
    """Assemblies of one entry share its group; other files are their own."""
    entry = F.nullif(F.regexp_extract(case_id(path), r"^(.{4})(?:[-_].*)?[-_]assembly[-_]?[a-z0-9]+(?:$|[-_])", 1), F.lit(""))
    return F.coalesce(F.concat(F.lit("pdb:"), entry), F.concat(F.lit("path:"), path))


def spaceless(c: Column) -> Column:
    """X11: without white space; letters keep their case."""
    return F.regexp_replace(c, r"\s+", "")


def sequence_key(c: Column) -> Column:
    """Without white space, in upper case."""
    return F.upper(F.regexp_replace(c, r"\s+", ""))


def letters_only(c: Column) -> Column:
    """Upper-case letters only."""
    return F.regexp_replace(F.upper(c), "[^A-Z]", "")


def assembly_order(c: Column) -> Column:
    """Numbers by value before all other names."""
    n = F.when(c.rlike(r"^\d+$"), c.try_cast("decimal(38,0)"))
    return F.struct(n.isNull().alias("text"), F.coalesce(n, F.lit(0)).alias("value"), c.alias("name"))


def _ids(group: Column) -> Column:
    """Members of one group: names and ranges, which may descend."""
    def one(item: Column) -> Column:
        low = F.regexp_extract(item, r"^(\d+)-(\d+)$", 1).try_cast("int")
        high = F.regexp_extract(item, r"^(\d+)-(\d+)$", 2).try_cast("int")
        span = F.transform(F.sequence(low, high, F.when(low <= high, 1).otherwise(-1)), lambda x: x.cast("string"))
        return F.when(low.isNotNull() & high.isNotNull(), span).otherwise(F.array(item))

    items = F.filter(F.transform(F.split(group, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.flatten(F.transform(items, one))


def operations(c: Column) -> Column:
    """The distinct operations of an expression in order; groups in brackets multiply, joined by 'x'."""
    text = null_text(c)
    flat = F.regexp_replace(text, r"\s+", "")
    groups = F.when(flat.contains("("), F.regexp_extract_all(flat, F.lit(r"\(([^()]*)\)"), F.lit(1))).otherwise(F.array(flat))

    def times(done: Column, group: Column) -> Column:
        return F.flatten(F.transform(done, lambda a: F.transform(_ids(group), lambda b: F.when(a == "", b).otherwise(F.concat(a, F.lit("x"), b)))))

    found = F.aggregate(groups, F.array(F.lit("")), times)
    return F.when(text.isNull(), F.array(F.lit("1"))).otherwise(F.array_distinct(found))


def polymer_class(chain_type: Column, polymer_type: Column) -> Column:
    """By chain type first; nucleic acids and other polymers by their polymer type; null for what is no polymer."""
    p = F.lower(F.coalesce(polymer_type, F.lit("")))
    sugar = F.when(p.contains("deoxyribo"), "dna").when(p.contains("ribo"), "rna")
    return (
        F.when(chain_type.isin(*X.PROTEIN_TYPES), "protein").when(chain_type == "DNA chain", "dna").when(chain_type == "RNA chain", "rna")
        .when(chain_type == "other nucleic acid chain", F.coalesce(sugar, F.lit("other_nucleic_acid")))
        .when(chain_type == X.OTHER_POLYMER, F.coalesce(sugar, F.when(p.contains("peptide"), "protein"), F.lit("other_polymer")))
    )


def is_polymer(chain_type: Column) -> Column:
    """F10."""
    return F.coalesce(chain_type.isin(*X.POLYMER_TYPES), F.lit(False))


def has_identity(kind: Column, sequence: Column, details: Column) -> Column:
    """a sequence, or for other polymers a named component among its details."""
    named = F.coalesce(F.exists(details, lambda x: null_text(x["monomer_id"]).isNotNull()), F.lit(False))
    return (F.coalesce(sequence, F.lit("")) != "") | ((kind == "other_polymer") & named)


def output_group(chain_type: Column) -> Column:
    """the exported group of a chain."""
    return (
        F.when(chain_type.isin(*X.PROTEIN_TYPES), "protein_chains").when(chain_type.isin(*X.NUCLEIC_TYPES), "nucleic_acid_chains")
        .when(chain_type == X.GLYCAN, "branched_entities").when(chain_type == X.METAL, "metal_ions")
        .when(chain_type == X.SMALL_MOLECULE, "small_molecule_compounds").otherwise("other_entities")
    )


def standard_monomer(chain_type: Column, monomer: Column) -> Column:
    """whether a residue is one of its chain type's standard ones."""
    m = F.upper(monomer)
    return (
        F.when(chain_type.isin(*X.PROTEIN_TYPES), m.isin(*X.AMINO_ACIDS)).when(chain_type == "DNA chain", m.isin(*X.DNA_NUCLEOTIDES))
        .when(chain_type == "RNA chain", m.isin(*X.RNA_NUCLEOTIDES))
        .when(chain_type == "other nucleic acid chain", m.isin(*X.DNA_NUCLEOTIDES, *X.RNA_NUCLEOTIDES)).otherwise(F.lit(False))
    )


def confidence(score: Column, least: Column) -> Column:
    """High from 140, medium from the limit, else low."""
    return F.when(score >= 140, "high").when(score >= least, "medium").otherwise("low")


def confidence_score(label: Column) -> Column:
    """X19."""
    return F.when(label == "high", 0.95).when(label == "medium", 0.85).when(label == "low", 0.7)


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Length that two half-open intervals share."""
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def interface_label(type_1: Column, type_2: Column, same_entity: Column) -> Column:
    """Both types in order, joined; for one entity only the first of them, marked."""
    types = F.array_sort(F.array(type_1, type_2))
    return F.when(same_entity, F.concat(F.lit("same-entity:"), types[0])).otherwise(F.array_join(types, "__"))


def monomer_id(entry: Column, assembly: Column, chain: Column) -> Column:
    """Entry, assembly (unless empty) and chain, joined by ':'."""
    return F.concat_ws(":", entry, F.nullif(assembly, F.lit("")), chain)


def multimer_type(instances: Column, entities: Column) -> Column:
    """By the number of instances and of distinct entities."""
    return (
        F.when((instances == 2) & (entities == 1), "homodimer").when(instances == 2, "tight_dimer")
        .when(entities == 1, "homomultimer").otherwise("heteromultimer")
    )


def component_key(details: Column, polymer_type: Column, description: Column, sequence: Column) -> Column:
    """Named components in order of position, with their types; without any, the texts that describe the polymer.

    ``details`` are structs of label_seq_id, monomer_id and chem_comp_type; one
    without a position has its place in the list.
    """
    def plain(c: Column) -> Column:
        return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))

    def token(x: Column) -> Column:
        name, kind = F.upper(F.trim(x["monomer_id"])), plain(x["chem_comp_type"])
        return F.when(kind != "", F.concat(name, F.lit(":"), kind)).otherwise(name)

    placed = F.transform(details, lambda x, i: F.struct(F.coalesce(x["label_seq_id"], i).alias("at"), i.alias("i"), token(x).alias("t"), null_text(x["monomer_id"]).alias("m")))
    ordered = F.array_sort(F.filter(placed, lambda x: x["m"].isNotNull()))
    rest = F.concat(F.lit("fallback|polymer_type="), plain(polymer_type), F.lit("|description="), plain(description), F.lit("|sequence="), sequence_key(F.coalesce(sequence, F.lit(""))))
    return F.when(F.size(ordered) > 0, F.array_join(F.transform(ordered, lambda x: x["t"]), "|")).otherwise(rest)


def method_priority(method: Column) -> Column:
    """X-ray diffraction, then electron microscopy, then NMR in solution or solid state, then all others."""
    m = F.lower(F.trim(F.coalesce(method, F.lit(""))))
    return F.when(m == "x-ray diffraction", 0).when(m == "electron microscopy", 1).when(m.isin("solution nmr", "solid-state nmr"), 2).otherwise(99)


def primary_method(methods: Column) -> Column:
    """Of several methods the first by priority, then name."""
    ranked = F.array_sort(F.transform(F.filter(methods, lambda x: F.trim(x) != ""), lambda x: F.struct(method_priority(x).alias("p"), x.alias("m"))))
    return F.try_element_at(ranked, F.lit(1))["m"]


def cutoff_date(c: Column) -> Column:
    """a cutoff as a strict date; blank is none, anything else fails the job."""
    t = F.trim(F.coalesce(c, F.lit("")))
    bad = F.raise_error(F.concat(F.lit("cutoff is not a date of the form YYYY-MM-DD: "), t)).cast("date")
    return F.when(t == "", F.lit(None).cast("date")).otherwise(F.coalesce(strict_date(t), bad))


def element_symbol(element: Column, atom: Column) -> Column:
    """The element, else the first letter (two for BR, CL and SE) of the atom's name."""
    e, letters = F.upper(F.trim(F.coalesce(element, F.lit("")))), F.upper(F.regexp_replace(F.coalesce(atom, F.lit("")), "[^A-Za-z]", ""))
    two = F.substring(letters, 1, 2)
    return F.when(e != "", e).when(two.isin("BR", "CL", "SE"), two).otherwise(F.substring(letters, 1, 1))


def is_hydrogen(element: Column, atom: Column) -> Column:
    """X34."""
    return element_symbol(element, atom).isin("H", "D", "T")


def residue_id(name: Column, number: Column, insertion: Column) -> Column:
    """Name, ':' and number with its insertion code."""
    return F.concat(name, F.lit(":"), number.cast("string"), F.trim(F.coalesce(insertion, F.lit(""))))


def leading_number(label: Column) -> Column:
    """The digits a numbering label starts with, 0 without any."""
    return F.coalesce(F.nullif(F.regexp_extract(F.coalesce(label.cast("string"), F.lit("")), r"^(\d+)", 1), F.lit("")).cast("int"), F.lit(0))


def first_motif(sequence: Column, motifs: tuple[str, ...]) -> Column:
    """The first of the motifs that the sequence holds."""
    return F.coalesce(*[F.when(sequence.contains(m), m) for m in motifs])


def warning_codes(c: Column) -> Column:
    """Codes of a text separated by ';'."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")


def distinct_in_order(c: Column) -> Column:
    """Without nulls and blanks, each value once, in order."""
    return F.array_distinct(F.filter(c, lambda x: x.isNotNull() & (x != "")))


def slug(c: Column) -> Column:
    """Runs of other characters than letters, digits and '_.=-' become one '_', none at the ends; nothing left is 'case'."""
    out = F.regexp_replace(F.regexp_replace(c, r"[^A-Za-z0-9_.=-]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(out, F.lit("")), F.lit("case"))


def html_text(c: Column) -> Column:
    """A value as escaped text; '&' goes first."""
    out = c.cast("string")
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def moved_path(path: Column, folder: str | None) -> Column:
    """The file's name under another folder, where one is given."""
    return path if not folder else F.concat(F.lit(folder.rstrip("/") + "/"), base_name(path))


def fingerprint(settings: Column, ignored: tuple[str, ...] = ()) -> Column:
    """SHA-256 of a map of settings as JSON in order of keys, without the ignored ones."""
    kept = F.map_filter(settings, lambda k, _: ~k.isin(*ignored)) if ignored else settings
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept)))), 256)


def interface_key(mode: Column, assembly: Column, left: Column, right: Column, label: Column, same: Column) -> Column:
    """What copies of an interface have in common; both sides (structs of chain, entity, type) in order."""
    return F.struct(mode.alias("mode"), assembly.alias("assembly"), F.array_sort(F.array(left, right)).alias("sides"), label.alias("label"), same.alias("same"))


def alignment_key(*parts: Column) -> Column:
    """32 hexadecimal digits of SHA-256 over the parts of an alignment's key."""
    return F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 32)


def sub_cluster(cluster: Column, number: Column) -> Column:
    """The number of a structure cluster after its sequence cluster's id."""
    return F.concat(cluster, F.lit("_"), number.cast("string"))
