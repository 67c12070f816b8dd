"""High-order observations, their signatures, and clusters of like structures inside a signature.

Observations are rows of the prep tables (nested values as JSON). Each member's
cluster is a mandatory lookup: a member without one fails the job. Signatures
are canonical JSON (keys and members in order); equal ones are a group, and the
structures of a group are compared with leaders in order of quality.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.scalars import monomer_id
from helixframe.operators import clustering, relational, superposition
from helixframe.operators.tables import written

_TEXTS = "array<string>"


def assignments(sequence: DataFrame, structure: DataFrame | None = None) -> DataFrame:
    """(monomer_id, cluster_source, cluster_id, sequence_cluster_id): the structure cluster where there is one, else the sequence cluster."""
    rows = sequence.select(F.col("member_monomer_id").alias("monomer_id"), F.col("cluster_id").alias("sequence_cluster_id"))
    rows = rows.groupBy("monomer_id").agg(F.max("sequence_cluster_id").alias("sequence_cluster_id"))
    if structure is None:
        rows = rows.withColumn("structure_cluster_id", F.lit(None).cast("string"))
    else:
        own = structure.groupBy(F.col("member_monomer_id").alias("monomer_id")).agg(F.max("structure_cluster_id").alias("structure_cluster_id"))
        rows = rows.join(own, "monomer_id", "full")
    named, plain = F.nullif("structure_cluster_id", F.lit("")), F.nullif("sequence_cluster_id", F.lit(""))
    return rows.select("monomer_id", F.when(named.isNotNull(), "structure").otherwise("sequence").alias("cluster_source"), F.coalesce(named, plain).alias("cluster_id"), plain.alias("sequence_cluster_id")).where("cluster_id is not null")


def in_scope(rows: DataFrame, inventory: DataFrame) -> DataFrame:
    """Observations of the sources that the monomer inventory covers."""
    return relational.semi(rows, inventory, ["source_path"])


def _list(c: str) -> Column:
    return F.coalesce(F.from_json(c, _TEXTS), F.array().cast(_TEXTS))


def _members(rows: DataFrame, lists: dict[str, Column], known: DataFrame, optional: tuple[str, ...] = ()) -> DataFrame:
    """Members of each observation with their clusters; those of an optional kind may have none.

    ``lists`` maps a kind to an array of structs (chain, label, n).
    """
    def named(kind: str, items: Column) -> Column:
        return F.transform(items, lambda x: F.struct(F.lit(kind).alias("kind"), x["chain"].alias("chain"), x["label"].alias("label"), x["n"].alias("n")))

    each = F.array(*[named(k, a) for k, a in lists.items()])
    out = rows.select("observation_id", "pdb_id", "_asm", F.explode(F.flatten(each)).alias("m")).select("observation_id", "pdb_id", "_asm", "m.*")
    out = out.withColumn("monomer_id", monomer_id(F.col("pdb_id"), F.col("_asm"), F.col("chain"))).drop("pdb_id", "_asm")
    need = out.where(~F.col("kind").isin(*optional)) if optional else out
    found = relational.looked_up(need, known, ["monomer_id"], "cluster")
    if optional:
        found = found.unionByName(out.where(F.col("kind").isin(*optional)).join(known, "monomer_id", "left"))
    return found


def _sorted(kind: str) -> Column:
    return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("label", F.col("cluster_id").alias("cluster"), "n"))))


def _item(chain: Column, label: Column | None = None, n: Column | None = None) -> Column:
    return F.struct(chain.alias("chain"), (F.lit("") if label is None else F.coalesce(label, F.lit(""))).alias("label"), (F.lit(0) if n is None else n).alias("n"))


def _described(c: str, label: str = "chain_type", counted: bool = False) -> Column:
    """Members as they stand in a signature: keys in order."""
    def one(x: Column) -> Column:
        parts = {label: x["label"], "monomer_cluster_id": x["cluster"]} | ({"copy_number": x["n"]} if counted else {})
        return F.struct(*[parts[k].alias(k) for k in sorted(parts)])

    return F.transform(c, one)


def _key(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def _signed(rows: DataFrame, found: DataFrame, kinds: list[str], parts: Callable[[], dict[str, Column]]) -> DataFrame:
    grouped = found.groupBy("observation_id").agg(
        *[_sorted(k).alias(f"_{k}") for k in kinds], F.array_sort(F.collect_list(F.struct("kind", "chain", "monomer_id", "cluster_source", "cluster_id", "sequence_cluster_id"))).alias("members")
    )
    joined = rows.join(grouped, "observation_id")
    return joined.withColumn("signature_key", _key(parts())).drop(*[f"_{k}" for k in kinds])


def dimer_observations(dimers: DataFrame, known: DataFrame) -> DataFrame:
    """Interfaces with both members' clusters and their signature. There are two members, so each is a lookup and nothing is gathered by observation: equal rows stay rows."""
    rows = dimers.where("pdb_id <> '' and label_asym_id_1 <> '' and label_asym_id_2 <> ''")
    for i in (1, 2):
        side = known.select(F.col("monomer_id").alias(f"_id{i}"), F.struct("cluster_source", "cluster_id", "sequence_cluster_id").alias(f"_c{i}"))
        rows = relational.looked_up(rows.withColumn(f"_id{i}", monomer_id(F.col("pdb_id"), F.coalesce("assembly_id", F.lit("")), F.col(f"label_asym_id_{i}"))), side, [f"_id{i}"], "cluster")
    label = lambda i: F.coalesce(f"chain_type_{i}", F.lit("")).alias("label")
    both = F.array_sort(F.array(*[F.struct(label(i), F.col(f"_c{i}.cluster_id").alias("cluster"), F.lit(0).alias("n")) for i in (1, 2)]))
    full = F.array_sort(F.array(*[F.struct(F.lit("member").alias("kind"), F.col(f"label_asym_id_{i}").alias("chain"), F.col(f"_id{i}").alias("monomer_id"), f"_c{i}.cluster_source", f"_c{i}.cluster_id", f"_c{i}.sequence_cluster_id") for i in (1, 2)]))
    flags = {k: F.coalesce(F.col(k), F.lit(False)) for k in ("is_same_entity", "contains_antibody_unit", "contains_tcr_pmhc_unit")}
    key = _key({"members": _described("_member"), "interface_label": F.coalesce("interface_label", F.lit("")), **flags})
    return rows.select(*dimers.columns, both.alias("_member"), full.alias("members")).withColumn("signature_key", key).drop("_member")


def multimer_observations(multimers: DataFrame, known: DataFrame) -> DataFrame:
    """Multimers with each member's cluster and number of copies."""
    rows = multimers.withColumn("_asm", F.coalesce("assembly_id", F.lit(""))).where(F.size(_list("member_chain_ids")) > 0)
    copies = F.coalesce(F.from_json("member_copy_numbers", "array<int>"), F.array().cast("array<int>"))
    # Lists of unlike length are cut to the shortest.
    zipped = F.arrays_zip(_list("member_chain_ids").alias("c"), _list("member_chain_types").alias("t"), copies.alias("n"))
    short = F.slice(zipped, 1, F.least(F.size(_list("member_chain_ids")), F.size(_list("member_chain_types")), F.size(copies)))
    items = F.transform(short, lambda x: _item(x["c"], x["t"], F.coalesce(x["n"], F.lit(0))))
    found = _members(rows.select("observation_id", "pdb_id", "_asm", items.alias("b")), {"member": F.col("b")}, known)
    flags = {k: F.coalesce(F.col(k), F.lit(False)) for k in ("contains_antibody_unit", "contains_tcr_pmhc_unit")}
    return _signed(rows.drop("_asm"), found, ["member"], lambda: {"members": _described("_member", counted=True), "multimer_type": F.coalesce("multimer_type", F.lit("")), **flags})


def antibody_role(chain: Column, heavy: Column, light: Column) -> Column:
    """C33."""
    return F.when(chain == heavy, "heavy").when(chain == light, "light").otherwise("antibody_member")


def tcr_roles(kind: Column, count: Column) -> Column:
    """Roles by place: those of a known pair, then numbered ones."""
    base = F.when(kind == "alpha_beta", F.array(F.lit("alpha"), F.lit("beta"))).when(kind == "gamma_delta", F.array(F.lit("gamma"), F.lit("delta"))).otherwise(F.array().cast(_TEXTS))
    more = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda k: F.coalesce(F.try_element_at(base, k), F.concat(F.lit("tcr_"), k.cast("string"))))
    return F.slice(more, 1, count)


_NONPOLYMER = "auxiliary_nonpolymer"


def _auxiliary(found: DataFrame, inventory: DataFrame, kinds: tuple[str, ...], typed: tuple[str, ...]) -> DataFrame:
    """Labels of members whose chain type comes from the inventory; auxiliary ones without a cluster are no polymers."""
    types = inventory.groupBy("monomer_id").agg(F.max("chain_type").alias("_type"))
    out = found.join(types, "monomer_id", "left")
    bare = F.col("kind").isin(*kinds) & F.col("cluster_id").isNull()
    label = F.when(bare, _NONPOLYMER).when(F.col("kind").isin(*kinds, *typed), F.coalesce("_type", F.lit(""))).otherwise(F.col("label"))
    return out.withColumn("label", label).withColumn("cluster_id", F.when(bare, _NONPOLYMER).otherwise(F.col("cluster_id"))).drop("_type")


def antibody_observations(complexes: DataFrame, known: DataFrame, inventory: DataFrame) -> DataFrame:
    """Antibody complexes with roles and clusters of their members."""
    rows = complexes.withColumn("_asm", F.coalesce("assembly_id", F.lit("")))
    own = F.transform(_list("antibody_chain_ids"), lambda c: _item(c, antibody_role(c, F.col("antibody_heavy_chain"), F.col("antibody_light_chain"))))
    kinds = F.arrays_zip(_list("antigen_chain_ids").alias("c"), _list("antigen_chain_types").alias("t"))
    antigen = F.transform(F.slice(kinds, 1, F.least(F.size(_list("antigen_chain_ids")), F.size(_list("antigen_chain_types")))), lambda x: _item(x["c"], x["t"]))
    beside = F.transform(_list("auxiliary_component_ids"), lambda c: _item(c))
    lists = rows.select("observation_id", "pdb_id", "_asm", own.alias("a"), antigen.alias("g"), beside.alias("x"))
    found = _members(lists, {"antibody": F.col("a"), "antigen": F.col("g"), "auxiliary": F.col("x")}, known, ("auxiliary",))
    found = _auxiliary(found, inventory, ("auxiliary",), ())
    of = lambda role: F.coalesce(F.filter("_antibody", lambda x: x["label"] == role)[0]["cluster"], F.lit(""))
    return _signed(rows.drop("_asm"), found, ["antibody", "antigen", "auxiliary"], lambda: {
        "antibody_unit_type": F.coalesce("antibody_unit_type", F.lit("")), "heavy_cluster_id": of("heavy"), "light_cluster_id": of("light"), "antibody_members": _described("_antibody", "role"),
        "antigen_members": _described("_antigen"), "auxiliary_components": _described("_auxiliary"), "num_auxiliary_branched": F.size(_list("auxiliary_branched_ids")),
    })


def tcr_observations(complexes: DataFrame, known: DataFrame, inventory: DataFrame) -> DataFrame:
    """Receptor complexes with roles and clusters of their members."""
    rows = complexes.withColumn("_asm", F.coalesce("assembly_id", F.lit("")))
    chains = _list("tcr_chain_ids")
    own = F.transform(F.arrays_zip(chains.alias("c"), tcr_roles(F.col("tcr_type"), F.size(chains)).alias("r")), lambda x: _item(x["c"], x["r"]))
    roles = F.arrays_zip(_list("mhc_chain_ids").alias("c"), _list("mhc_chain_roles").alias("r"))
    mhc = F.transform(F.slice(roles, 1, F.least(F.size(_list("mhc_chain_ids")), F.size(_list("mhc_chain_roles")))), lambda x: _item(x["c"], x["r"]))
    lists = rows.select("observation_id", "pdb_id", "_asm", own.alias("t"), mhc.alias("h"), F.transform(_list("peptide_chain_ids"), lambda c: _item(c)).alias("p"), F.transform(_list("auxiliary_chain_ids"), lambda c: _item(c)).alias("x"))
    found = _members(lists, {"tcr": F.col("t"), "mhc": F.col("h"), "peptide": F.col("p"), "auxiliary": F.col("x")}, known, ("auxiliary",))
    found = _auxiliary(found, inventory, ("auxiliary",), ("peptide",))
    return _signed(rows.drop("_asm"), found, ["tcr", "mhc", "peptide", "auxiliary"], lambda: {
        "tcr_type": F.coalesce("tcr_type", F.lit("")), "mhc_class": F.coalesce("mhc_class", F.lit("")), "tcr_members": _described("_tcr", "role"), "mhc_members": _described("_mhc", "role"),
        "peptide_members": _described("_peptide"), "auxiliary_members": _described("_auxiliary"),
    })


# Order of observations inside a group

ORDERS = {
    "dimers": ["buried_area", "num_atom_contacts", "num_residue_contacts"], "multimers": ["support_score", "num_internal_edges", "num_member_instances"],
    "antibody_complexes": ["contact_score", "num_antibody_antigen_interfaces", "num_antigen_chains"], "tcr_complexes": ["contact_score", "num_tcr_pmhc_interfaces", "num_peptide_chains"],
}
# Prefixes of signature and structure clusters.
PREFIXES = {"dimers": ("dimsig_", "dim_"), "multimers": ("mulsig_", "mul_"), "antibody_complexes": ("abagsig_", "abag_"), "tcr_complexes": ("tcrsig_", "tcrcx_")}


def structural_order(stage: str) -> list[Column]:
    """Larger measures first, then the observation's id."""
    return [*[F.coalesce(F.col(c), F.lit(0)).desc() for c in ORDERS[stage]], F.col("observation_id").asc()]


def quality_order() -> list[Column]:
    """Method, resolution (missing last), resolved share, id."""
    return [F.coalesce("method_priority", F.lit(99)).asc(), F.col("resolution").asc_nulls_last(), F.coalesce("resolved_fraction", F.lit(0.0)).desc(), F.col("monomer_id").asc()]


def resolved_residues(segments: Column) -> Column:
    """Residues in well-formed segments."""
    ok = F.filter(segments, lambda x: x["label_seq_start"].isNotNull() & (x["label_seq_end"] >= x["label_seq_start"]))
    return F.aggregate(ok, F.lit(0), lambda n, x: n + x["label_seq_end"] - x["label_seq_start"] + 1)


# Alignment


def align(a: np.ndarray, b: np.ndarray) -> dict:
    """Residue pairs of two traces in order, their scores by both lengths, deviation, and coverage of the shorter."""
    return superposition.align_many([(a, b)])[0]


def accepts(found: dict, least_score: float = 0.5, least_coverage: float | None = 0.5) -> bool:
    """The better score and, for monomers, the coverage of the shorter trace."""
    enough = least_coverage is None or found["coverage"] >= least_coverage
    return max(found["tm_score_query"], found["tm_score_target"]) >= least_score and enough


def _same(a: list[np.ndarray], b: list[np.ndarray]) -> bool:
    return len(a) == len(b) and all(x.shape == y.shape and (x == y).all() for x, y in zip(a, b, strict=True))


def _accepted(pairs: list[tuple], least_coverage: float | None, aligned) -> list[bool]:
    """Whether leaders accept members, pair by pair; equal structures need no alignment (C11), empty ones are accepted by none."""
    out = [bool(sum(map(len, a))) and _same(a, b) for a, b in pairs]
    open_pairs = [k for k, (a, _) in enumerate(pairs) if sum(map(len, a)) and not out[k]]
    for k, found in zip(open_pairs, aligned([pairs[k] for k in open_pairs]), strict=True):
        out[k] = accepts(found, least_coverage=least_coverage)
    return out


def trace_pairs(pairs: list[tuple], least_coverage: float | None = 0.5) -> list[bool]:
    """Whether leaders accept members, pairs of traces; all are aligned in batches."""
    shaped = [tuple([np.asarray(x, float).reshape(-1, 3)] for x in pair) for pair in pairs]
    return _accepted(shaped, least_coverage, lambda pairs: superposition.align_many([(a[0], b[0]) for a, b in pairs]))


def complex_pairs(pairs: list[tuple]) -> list[bool]:
    """Whether leaders accept members, pairs of lists of traces of their chains, in any order."""
    shaped = [tuple([np.asarray(p, float).reshape(-1, 3) for p in x] for x in pair) for pair in pairs]
    return _accepted(shaped, None, superposition.align_complexes)


def _matrix(leaders: list, members: list, pairs) -> np.ndarray:
    """Which leaders accept which members."""
    return np.array(pairs([(a, b) for b in members for a in leaders]), bool).reshape(len(members), len(leaders))


def trace_rows(leaders: list, members: list, least_coverage: float | None = 0.5) -> np.ndarray:
    """Which leaders accept which members, both as traces; all pairs are aligned in batches."""
    return _matrix(leaders, members, lambda pairs: trace_pairs(pairs, least_coverage))


def complex_rows(leaders: list, members: list) -> np.ndarray:
    """Which leaders accept which members, both as lists of traces of their chains, in any order."""
    return _matrix(leaders, members, complex_pairs)


def traces(atoms: DataFrame, keys: list[str]) -> DataFrame:
    """CA (or P) places of each residue in order, the first of each; all atoms where there are none."""
    named = F.col("atom_name").isin("CA", "P")
    rows = atoms.withColumn("_n", named.cast("int")).withColumn("_any", F.max("_n").over(Window.partitionBy(*keys))).where("_n = _any")
    once = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "res_id", "ins_code", *[F.when(F.col("_any") == 0, F.col("atom_idx"))]).orderBy("atom_idx"))).where("_r = 1")
    place = F.struct("atom_idx", "x", "y", "z")
    return once.groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_list(place)), lambda p: F.array(p["x"], p["y"], p["z"]))).alias("trace"))


def fingerprint(atoms: DataFrame, keys: list[str]) -> DataFrame:
    """24 hexadecimal digits over places and identities of a structure's atoms in order."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("chain_id", "res_id", "ins_code", "res_name", "atom_name", "x", "y", "z")])
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("atom_idx", text.alias("t")))), lambda x: x["t"]), "\n")
    return atoms.groupBy(*keys).agg(F.substring(F.sha2(whole, 256), 1, 24).alias("coordinate_fingerprint"))


# Stages


def signature_table(observations: DataFrame, stage: str) -> DataFrame:
    """Observations with the number and size of their signature's group."""
    numbered = clustering.signature_groups(observations.select("observation_id", "signature_key"), "observation_id", "signature_key", PREFIXES[stage][0])
    return numbered.select("observation_id", F.col("cluster_id").alias("signature_cluster_id"), F.col("size").alias("signature_cluster_size"))


def refined(observations: DataFrame, structures: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """Structure clusters of each signature's observations, and warnings.

    ``structures`` has observation_id and parts, a trace for each chain; complexes
    are compared with their chains assigned, so the order of parts is of no matter.
    A group of one needs no structure. Members of larger groups without one are
    left out with a warning.
    """
    signed = written(observations.join(signature_table(observations, stage), "observation_id").join(structures, "observation_id", "left"))
    alone = F.col("signature_cluster_size") == 1
    missing = signed.where(~alone & F.col("parts").isNull()).select("signature_cluster_id", "observation_id", F.lit("structure_unavailable").alias("warning"))
    kept = signed.where(alone | F.col("parts").isNotNull())
    place = F.row_number().over(Window.partitionBy("signature_cluster_id").orderBy(*structural_order(stage)))
    kept = kept.withColumn("place", place)
    led = clustering.leader_clusters(
        kept.select("signature_cluster_id", "observation_id", "place", F.coalesce("parts", F.array().cast("array<array<double>>")).alias("parts")),
        "signature_cluster_id", "observation_id", ["place"], "parts", complex_rows, "string", pairs=complex_pairs,
    )
    order = kept.select(F.col("observation_id").alias("leader"), F.col("place").alias("_p"))
    local = F.dense_rank().over(Window.partitionBy("signature_cluster_id").orderBy("_p"))
    name = F.concat(F.lit(PREFIXES[stage][1]), F.regexp_extract("signature_cluster_id", r"(\d+)$", 1), F.lit("_"), F.col("local").cast("string"))
    rows = led.join(order, "leader").withColumn("local", local).withColumn("cluster_id", name)
    out = rows.select("signature_cluster_id", "cluster_id", F.col("leader").alias("representative_id"), "observation_id")
    return out.join(kept.drop("parts", "signature_cluster_id"), "observation_id"), missing


def structure_clusters(members: DataFrame) -> DataFrame:
    """Monomers of a sequence cluster in order of quality join the first leader that accepts their trace.

    ``members`` has sequence_cluster_id, monomer_id, sequence, method_priority,
    resolution, resolved_fraction, trace. Of equal sequences only the best copy
    is compared; the others follow it.
    """
    w = Window.partitionBy("sequence_cluster_id").orderBy(*quality_order())
    ranked = written(members.withColumn("place", F.row_number().over(w)).withColumn("_s", F.md5("sequence")))
    best = ranked.where("trace is not null").groupBy("sequence_cluster_id", "_s").agg(F.min_by("monomer_id", "place").alias("best"), F.min("place").alias("place"))
    compared = ranked.select("sequence_cluster_id", "monomer_id", "place", "trace").join(best.select("sequence_cluster_id", F.col("best").alias("monomer_id")), ["sequence_cluster_id", "monomer_id"], "left_semi")
    led = clustering.leader_clusters(compared, "sequence_cluster_id", "monomer_id", ["place"], "trace", trace_rows, "string", pairs=trace_pairs)
    order = ranked.select(F.col("monomer_id").alias("leader"), F.col("place").alias("_p"))
    local = F.dense_rank().over(Window.partitionBy("sequence_cluster_id").orderBy("_p"))
    led = led.join(order, "leader").withColumn("local", local).withColumnRenamed("monomer_id", "best")
    out = ranked.join(best.drop("place"), ["sequence_cluster_id", "_s"]).join(led.select("sequence_cluster_id", "best", "leader", "local"), ["sequence_cluster_id", "best"])
    reason = F.when(F.col("monomer_id") == F.col("leader"), "representative").when(F.col("monomer_id") == F.col("best"), "structure_alignment").otherwise("identical_sequence")
    return out.select(
        "sequence_cluster_id", F.concat("sequence_cluster_id", F.lit("_"), F.col("local").cast("string")).alias("structure_cluster_id"), F.col("leader").alias("representative_monomer_id"),
        F.col("monomer_id").alias("member_monomer_id"), reason.alias("assignment_reason"),
    )


def unusable(members: DataFrame) -> DataFrame:
    """Members without a structure."""
    return members.where("trace is null or size(trace) = 0").select("sequence_cluster_id", "monomer_id")


# Interfaces of structures


def interface_residues(atoms: DataFrame, cutoff: float = 8.0) -> DataFrame:
    """Residues with an atom within the cutoff of the other part. ``atoms`` has structure, part (1 or 2), chain_id, res_id, ins_code, atom_idx, x, y, z."""
    from helixframe.operators import geometry

    rows = atoms.select("structure", F.col("atom_idx").alias("id"), F.col("part").cast("string").alias("owner"), "x", "y", "z")
    near = geometry.contacts(rows, rows, "structure", cutoff).where("owner <> owner_2").select("structure", F.col("id").alias("atom_idx")).distinct()
    return atoms.join(near, ["structure", "atom_idx"]).select("structure", "part", "chain_id", "res_id", "ins_code").distinct()


def common_symmetry(parts: DataFrame) -> DataFrame:
    """The least copy number that all chains of a structure have. ``parts``: structure, chain_id, sym_id."""
    n = parts.groupBy("structure").agg(F.countDistinct("chain_id").alias("_n"))
    held = parts.groupBy("structure", "sym_id").agg(F.countDistinct("chain_id").alias("_m"))
    return held.join(n, "structure").where("_m = _n").groupBy("structure").agg(F.min("sym_id").alias("sym_id"))


def member_symmetry(instance: Column, operations: Column) -> Column:
    """An instance's copy: as given, else by its id after '@', else by its operation's place."""
    after = F.regexp_extract(F.coalesce(instance["instance_id"], F.lit("")), r"@(\d+)$", 1).try_cast("int") - 1
    place = F.array_position(operations, instance["operation_id"])
    return F.coalesce(instance["sym_id"], after, F.when(place > 0, (place - 1).cast("int")))


def instance_signature(instances: Column, chains: Column) -> Column:
    """What tells copies of one multimer apart: chain, copy and operation of each instance; else its chains."""
    none = F.array().cast(_TEXTS)
    given = F.transform(instances, lambda x: F.struct(F.coalesce(x["label_asym_id"], F.lit("")).alias("chain"), F.coalesce(member_symmetry(x, none), F.lit(-1)).alias("sym"), F.coalesce(x["operation_id"], F.lit("")).alias("op")))
    plain = F.transform(chains, lambda c: F.struct(c.alias("chain"), F.lit(-1).alias("sym"), F.lit("").alias("op")))
    return F.to_json(F.array_sort(F.when(F.size(F.coalesce(instances, F.array().cast("array<string>"))) > 0, given).otherwise(plain)))


def pair_similarity(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Identity of two sequences by a global alignment (affine gaps), over the shorter one."""

    def run(batches):
        for pdf in batches:
            pdf["similarity"] = [sequence_identity(x or "", y or "") for x, y in zip(pdf[a], pdf[b], strict=True)]
            yield pdf

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, schema + ", similarity double")


def sequence_identity(a: str, b: str, match: float = 4.0, differ: float = -1.0, opened: float = -10.0, grown: float = -1.0) -> float:
    """Equal letters in the best global alignment with affine gaps, by the shorter length."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = np.frombuffer(a.encode("latin-1", "replace"), np.uint8), np.frombuffer(b.encode("latin-1", "replace"), np.uint8)
    n, m = len(x), len(y)
    low = -1e9
    # Best score, and equal letters on its way: for pairs, gaps in one and gaps in the other.
    d, up = np.full(m + 1, low), np.full(m + 1, low)
    side = opened + grown * np.arange(m + 1)
    d[0], side[0] = 0.0, low
    kd, ku, ks = (np.zeros(m + 1, int) for _ in range(3))
    for i in range(1, n + 1):
        best = np.maximum(np.maximum(d, up), side)
        kbest = np.where(d >= np.maximum(up, side), kd, np.where(up >= side, ku, ks))
        same = y == x[i - 1]
        nd, nkd = np.full(m + 1, low), np.zeros(m + 1, int)
        nd[1:], nkd[1:] = best[:-1] + np.where(same, match, differ), kbest[:-1] + same
        first = np.maximum(d, side) + opened
        nup = np.maximum(first, up + grown)
        nku = np.where(first >= up + grown, np.where(d >= side, kd, ks), ku)
        if i == 1:
            nup[0] = opened
        # Gaps along the row: the best start before each place, as a running maximum.
        start = np.maximum(nd, nup) + opened - grown * np.arange(1, m + 2)
        lead = np.maximum.accumulate(start)
        at = np.maximum.accumulate(np.where(start >= lead, np.arange(m + 1), 0))
        ns, nks = np.full(m + 1, low), np.zeros(m + 1, int)
        ns[1:] = lead[:-1] + grown * np.arange(1, m + 1)
        nks[1:] = np.where(nd >= nup, nkd, nku)[at[:-1]]
        d, up, side, kd, ku, ks = nd, nup, ns, nkd, nku, nks
    last = max((d[m], kd[m]), (up[m], ku[m]), (side[m], ks[m]))
    return float(last[1]) / min(n, m)
