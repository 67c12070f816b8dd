"""Antibody-antigen and receptor complexes of each case, from chains, interfaces and multimers.

Pairs of chains are matched greedily inside a case (``graphs.greedy_matching``
and ``graphs.greedy_pairs``); everything else is joins and aggregates by case.

Chains: case, label_asym_id, auth_asym_id, entity_id, entity_description,
chain_type, subtype, length, unit_type, covered_nonpolymer_ids,
covered_branched_ids. Interfaces: case, label_asym_id_1/2, chain_type_1/2,
buried_area, num_atom_contacts, num_residue_contacts. Multimers: case,
multimer_id, member_chain_ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import chains as K
from helixframe.functions import fixed as X
from helixframe.operators import graphs
from helixframe.operators.tables import written

HEAVY, LIGHT = X.ANTIBODY_TYPES
_TEXTS = "array<string>"


def sides(interfaces: DataFrame) -> DataFrame:
    """Each interface from both of its sides: chain, type, other, other_type."""
    measures = ["buried_area", "num_atom_contacts", "num_residue_contacts"]
    one = [
        interfaces.select(
            "case", F.col(f"label_asym_id_{i}").alias("chain"), F.col(f"chain_type_{i}").alias("type"), F.col(f"label_asym_id_{3 - i}").alias("other"),
            F.col(f"chain_type_{3 - i}").alias("other_type"), *measures,
        )
        for i in (1, 2)
    ]
    return one[0].unionByName(one[1])


def unit_type(chain_unit: Column, subtype: Column) -> Column:
    return F.coalesce(F.nullif(chain_unit, F.lit("")), subtype, F.lit(""))


def heavy_light_pairs(chains: DataFrame, interfaces: DataFrame) -> DataFrame:
    """(case, heavy, light) by area, atom and residue contacts; single-domain and fused units pair with none."""
    free = chains.where(~unit_type(F.col("unit_type"), F.col("subtype")).isin("VHH", "scFv"))
    rows = sides(interfaces).where((F.col("type") == HEAVY) & (F.col("other_type") == LIGHT)).select(
        "case", F.col("chain").alias("heavy"), F.col("other").alias("light"), "buried_area", "num_atom_contacts", "num_residue_contacts"
    )
    for name in ("heavy", "light"):
        rows = rows.join(free.select("case", F.col("label_asym_id").alias(name)), ["case", name], "left_semi")
    return graphs.greedy_matching(rows, "case", "heavy", "light", ["buried_area", "num_atom_contacts", "num_residue_contacts"], [True] * 3)


def heavy_only(chains: DataFrame, pairs: DataFrame) -> DataFrame:
    """Heavy chains with whether a light one was found and whether they are true heavy-only chains."""
    rows = chains.where(F.col("chain_type") == HEAVY).join(pairs.withColumnRenamed("heavy", "label_asym_id"), ["case", "label_asym_id"], "left")
    kind = F.coalesce("unit_type", F.lit(""))
    return rows.select("case", "label_asym_id", F.col("light").isNotNull().alias("paired_light_found"), (~kind.isin("VHH", "scFv") & F.col("light").isNull()).alias("is_true_heavy_only"))


def antibody_units(chains: DataFrame, pairs: DataFrame) -> DataFrame:
    """(case, unit, unit_type, heavy, light, members): one for each heavy chain, numbered in order of its members."""
    rows = chains.where(F.col("chain_type") == HEAVY).select("case", F.col("label_asym_id").alias("heavy"), "unit_type", "subtype")
    rows = rows.join(pairs, ["case", "heavy"], "left")
    named = F.coalesce(F.nullif("unit_type", F.lit("")), F.when(F.col("subtype").isin("VHH", "scFv"), F.col("subtype")))
    single = F.coalesce(named.isin("VHH", "scFv"), F.lit(False))
    light = F.when(~single, F.col("light"))
    kind = F.when(light.isNotNull(), "paired_heavy_light").otherwise(F.coalesce(named, F.lit("heavy_only")))
    members = F.filter(F.array("heavy", light), lambda x: x.isNotNull())
    out = rows.select("case", kind.alias("unit_type"), "heavy", light.alias("light"), members.alias("members"))
    return out.withColumn("unit", F.row_number().over(Window.partitionBy("case").orderBy("members", "unit_type")))


def antibody_complexes(chains: DataFrame, interfaces: DataFrame, multimers: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Each antibody unit with the chains that it touches, copies of an entity as one.

    Antigens are in order of their entity's area, then least chain; an entity's
    chain of most area, contacts, then least name stands for it.
    """
    pairs = heavy_light_pairs(chains, interfaces) if pairs is None else pairs
    units = antibody_units(chains, pairs)
    own = units.select("case", "unit", F.explode("members").alias("chain"))
    touch = sides(interfaces).where(~F.col("other_type").isin(*X.ANTIBODY_TYPES)).join(own, ["case", "chain"])
    # A unit's own chains are looked up with those that it touches; from there on all of a unit is in one place.
    mine = own.select("case", "unit", "chain", F.col("chain").alias("other"), F.lit(None).cast("double").alias("buried_area"), F.lit(None).cast("int").alias("num_atom_contacts"), F.lit(True).alias("mine"))
    touch = touch.select("case", "unit", "chain", "other", "buried_area", "num_atom_contacts", F.lit(False).alias("mine")).unionByName(mine)
    known = chains.select("case", F.col("label_asym_id").alias("other"), "auth_asym_id", "entity_id", "chain_type", "covered_nonpolymer_ids", "covered_branched_ids")
    touch = touch.join(known, ["case", "other"]).repartition("case", "unit")
    per = touch.groupBy("case", "unit", "mine", "entity_id", "other", "auth_asym_id", "chain_type", "covered_nonpolymer_ids", "covered_branched_ids").agg(
        F.round(F.sum("buried_area"), 4).alias("area"), F.sum("num_atom_contacts").alias("atoms"), F.count("*").alias("dimers"), F.collect_set("chain").alias("by"), F.sum("buried_area").alias("exact")
    )
    w = Window.partitionBy("case", "unit", "mine", "entity_id")
    ranked = per.withColumns({
        "_r": F.row_number().over(w.orderBy(F.desc("area"), F.desc("atoms"), "other")), "total_area": F.round(F.sum("area").over(w), 4), "total_atoms": F.sum("atoms").over(w),
        "copies": F.count("*").over(w), "least": F.min("other").over(w), "all_chains": F.collect_list(F.struct(-F.col("area"), -F.col("atoms"), F.col("other").alias("c"))).over(w),
    })
    item = F.struct(
        (-F.col("total_area")).alias("k"), F.col("least"), F.col("other").alias("chain"), "auth_asym_id", "entity_id", "chain_type", "copies", "covered_nonpolymer_ids", "covered_branched_ids",
        "total_area", "total_atoms", F.transform(F.array_sort("all_chains"), lambda x: x["c"]).alias("all_chain_ids"),
    )
    of = lambda mine, c: F.when(F.col("mine") == mine, c)
    found = ranked.groupBy("case", "unit").agg(
        F.array_sort(F.collect_list(of(False, F.when(F.col("_r") == 1, item)))).alias("antigens"), F.sum(of(False, F.col("dimers"))).alias("num_antibody_antigen_interfaces"),
        F.round(F.sum(of(False, F.col("exact"))), 4).alias("contact_score"), F.array_distinct(F.flatten(F.collect_list(of(False, F.col("by"))))).alias("_by"),
        F.flatten(F.collect_list(of(True, F.col("covered_nonpolymer_ids")))).alias("_n"), F.flatten(F.collect_list(of(True, F.col("covered_branched_ids")))).alias("_b"),
    )
    out = written(units.join(found.where("num_antibody_antigen_interfaces > 0"), ["case", "unit"]))
    ids = F.transform("antigens", lambda x: x["chain"])
    support = supporting_multimers(out.select("case", "unit", F.col("members").alias("all_of"), ids.alias("any_of")), multimers)
    out = out.join(support, ["case", "unit"], "left")
    union = lambda mine, theirs: F.array_sort(F.array_distinct(F.filter(F.concat(F.coalesce(mine, F.array().cast(_TEXTS)), F.flatten(F.transform("antigens", lambda x: F.coalesce(x[theirs], F.array().cast(_TEXTS))))), lambda x: x.isNotNull())))
    warnings = F.filter(F.array(
        F.when(F.col("unit_type") == "heavy_only", "heavy_chain_without_paired_light_chain"),
        F.when(F.exists("antigens", lambda x: x["copies"] > 1), "same_entity_antigen_copies_collapsed"),
        F.when(F.col("light").isNotNull() & ~F.array_contains("_by", F.col("heavy")), "paired_unit_antigen_contacts_not_on_heavy_chain"),
    ), lambda x: x.isNotNull())
    return out.select(
        "case", F.format_string("ab_ag_%03d", "unit").alias("complex_id"), F.col("unit_type").alias("antibody_unit_type"), F.col("heavy").alias("antibody_heavy_chain"), F.col("light").alias("antibody_light_chain"),
        F.col("members").alias("antibody_chain_ids"), ids.alias("antigen_chain_ids"), F.transform("antigens", lambda x: x["auth_asym_id"]).alias("antigen_auth_asym_ids"),
        F.transform("antigens", lambda x: x["entity_id"]).alias("antigen_entity_ids"), F.transform("antigens", lambda x: x["chain_type"]).alias("antigen_chain_types"),
        union(F.col("_n"), "covered_nonpolymer_ids").alias("auxiliary_component_ids"), union(F.col("_b"), "covered_branched_ids").alias("auxiliary_branched_ids"),
        F.size("antigens").alias("num_antigen_chains"), "num_antibody_antigen_interfaces", "contact_score", F.coalesce("supporting", F.array().cast(_TEXTS)).alias("supporting_multimer_ids"),
        F.transform("antigens", lambda x: F.struct(x["chain"].alias("antigen_label_asym_id"), x["total_area"].alias("total_buried_area"), x["total_atoms"].alias("total_atom_contacts"), x["all_chain_ids"].alias("all_antigen_chain_ids"))).alias("antigen_interface_summaries"),
        warnings.alias("warnings"),
    )


def supporting_multimers(units: DataFrame, multimers: DataFrame) -> DataFrame:
    """Multimers with every chain of ``all_of`` and, unless null, one at least of ``any_of``; pairs meet at a unit's first chain."""
    rows = units.select("case", "unit", "all_of", "any_of", F.col("all_of")[0].alias("chain"))
    held = multimers.select("case", "multimer_id", "member_chain_ids", F.explode(F.array_distinct("member_chain_ids")).alias("chain"))
    every = (F.size(F.array_except("all_of", "member_chain_ids")) == 0) & (F.col("any_of").isNull() | F.arrays_overlap("any_of", "member_chain_ids"))
    return rows.join(held, ["case", "chain"]).where(every).groupBy("case", "unit").agg(F.array_sort(F.collect_set("multimer_id")).alias("supporting"))


# Receptors


def pair_type(a: Column, b: Column) -> Column:
    """Alpha with beta, gamma with delta."""
    both = F.array_sort(F.array(F.coalesce(a, F.lit("unknown")), F.coalesce(b, F.lit("unknown"))))
    return F.when(both == F.array(F.lit("alpha"), F.lit("beta")), "alpha_beta").when(both == F.array(F.lit("delta"), F.lit("gamma")), "gamma_delta")


def _typed_pairs(chains: DataFrame, interfaces: DataFrame, kind: str) -> DataFrame:
    """Interfaces between two chains of a type, ends in order, with both ends' columns."""
    rows = interfaces.where((F.col("chain_type_1") == kind) & (F.col("chain_type_2") == kind)).select(
        "case", F.least("label_asym_id_1", "label_asym_id_2").alias("left"), F.greatest("label_asym_id_1", "label_asym_id_2").alias("right"), "buried_area", "num_atom_contacts"
    )
    own = chains.where(F.col("chain_type") == kind)
    for name in ("left", "right"):
        rows = rows.join(own.select("case", F.col("label_asym_id").alias(name), F.col("subtype").alias(f"{name}_subtype"), F.col("entity_description").alias(f"{name}_text")), ["case", name])
    return rows


def tcr_units(chains: DataFrame, interfaces: DataFrame) -> DataFrame:
    """Paired receptor chains by area, contacts and names, all descending; what is left stands alone.

    (case, unit, tcr_chain_ids, tcr_type, warnings)
    """
    rows = _typed_pairs(chains, interfaces, X.TCR).withColumn("tcr_type", pair_type(F.col("left_subtype"), F.col("right_subtype"))).where("tcr_type is not null")
    order = ["buried_area", "num_atom_contacts", "left", "right", "tcr_type"]
    matched = graphs.greedy_pairs(rows, "case", "left", "right", order, [True] * 5)
    kinds = rows.select("case", "left", "right", "tcr_type").distinct()
    paired = matched.join(kinds, ["case", "left", "right"]).select("case", F.array("left", "right").alias("tcr_chain_ids"), "tcr_type", F.array().cast(_TEXTS).alias("warnings"), "place")
    used = matched.select("case", F.explode(F.array("left", "right")).alias("label_asym_id"))
    alone = chains.where(F.col("chain_type") == X.TCR).join(used, ["case", "label_asym_id"], "left_anti")
    alone = alone.select("case", F.array("label_asym_id").alias("tcr_chain_ids"), F.coalesce("subtype", F.lit("single_tcr")).alias("tcr_type"), F.array(F.lit("unpaired_tcr_chain")).alias("warnings"), F.lit(1 << 30).alias("place"))
    w = Window.partitionBy("case").orderBy("place", "tcr_chain_ids")
    return paired.unionByName(alone).withColumn("unit", F.row_number().over(w)).drop("place")


def mhc_class(subtype: Column, description: Column) -> Column:
    """The class that a chain's subtype or description gives."""
    named = F.when(F.coalesce(subtype, F.lit("")).startswith("class_"), F.upper(F.regexp_replace(subtype, "^class_", "")))
    return F.coalesce(F.when(named != "UNKNOWN", named), F.nullif(K.mhc_class(description), F.lit("unknown")), F.lit("unknown"))


def mhc_role(subtype: Column, description: Column) -> Column:
    """X15-X17."""
    role = K.mhc_role(description)
    return F.when(role != "unknown", role).when(mhc_class(subtype, description) == "I", "class_i_heavy").otherwise("unknown")


def role_rank(role: Column) -> Column:
    """Alpha and class I chains come first, then beta ones."""
    return F.when(role.isin("class_ii_alpha", "class_i_heavy"), 0).when(role == "class_ii_beta", 1).otherwise(2)


def pmhc_units(chains: DataFrame, interfaces: DataFrame, multimers: DataFrame) -> DataFrame:
    """Class II chains of unlike roles in pairs, others alone, with auxiliary chains by interface or multimer.

    (case, unit, mhc_chain_ids, mhc_chain_roles, mhc_class, auxiliary_chain_ids, warnings)
    """
    rows = _typed_pairs(chains, interfaces, X.MHC)
    role = lambda s: mhc_role(F.col(f"{s}_subtype"), F.col(f"{s}_text"))
    second = lambda s: mhc_class(F.col(f"{s}_subtype"), F.col(f"{s}_text")) == "II"
    unlike = (role("left") == "unknown") | (role("right") == "unknown") | (role("left") != role("right"))
    rows = rows.where(second("left") & second("right") & unlike)
    matched = graphs.greedy_pairs(rows, "case", "left", "right", ["buried_area", "num_atom_contacts", "left", "right"], [True] * 4)
    mhc = chains.where(F.col("chain_type") == X.MHC).select(
        "case", F.col("label_asym_id").alias("chain"), mhc_role(F.col("subtype"), F.col("entity_description")).alias("role"), mhc_class(F.col("subtype"), F.col("entity_description")).alias("mhc_class")
    )
    mates = matched.select("case", F.col("left").alias("chain"), F.col("left").alias("unit_chain")).union(matched.select("case", "right", "left"))
    members = mhc.join(mates, ["case", "chain"], "left").withColumn("unit_chain", F.coalesce("unit_chain", "chain"))
    ordered = F.array_sort(F.collect_list(F.struct(role_rank(F.col("role")).alias("k"), "chain", "role")))
    units = members.groupBy("case", "unit_chain").agg(ordered.alias("_m"), F.min_by("mhc_class", "chain").alias("mhc_class"))
    ends = members.select("case", "chain", "unit_chain")
    aux = chains.where(F.col("chain_type") == X.AUXILIARY).select("case", F.col("label_asym_id").alias("other"))
    near = sides(interfaces).where(F.col("other_type") == X.AUXILIARY).select("case", "chain", "other")
    held = multimers.select("case", F.explode("member_chain_ids").alias("chain"), "member_chain_ids").select("case", "chain", F.explode("member_chain_ids").alias("other"))
    found = near.union(held).distinct().join(aux, ["case", "other"], "left_semi").join(ends, ["case", "chain"])
    found = found.groupBy("case", "unit_chain").agg(F.array_sort(F.collect_set("other")).alias("auxiliary_chain_ids"))
    out = units.join(found, ["case", "unit_chain"], "left").withColumn("auxiliary_chain_ids", F.coalesce("auxiliary_chain_ids", F.array().cast(_TEXTS)))
    bare = (F.col("mhc_class") == "I") & (F.size("auxiliary_chain_ids") == 0)
    warned = F.when(bare, F.array(F.lit("class_i_mhc_without_beta2m_or_auxiliary_chain"))).otherwise(F.array().cast(_TEXTS))
    return out.select(
        "case", F.row_number().over(Window.partitionBy("case").orderBy("unit_chain")).alias("pmhc_unit"), F.transform("_m", lambda x: x["chain"]).alias("mhc_chain_ids"),
        F.transform("_m", lambda x: x["role"]).alias("mhc_chain_roles"), "mhc_class", "auxiliary_chain_ids", warned.alias("pmhc_warnings"),
    )


def is_peptide(chain_type: Column, length: Column, most: int = X.PEPTIDE_LENGTH) -> Column:
    """F21."""
    return chain_type.isin(X.PEPTIDE, "other protein chain") & (length <= most)


def tcr_complexes(chains: DataFrame, interfaces: DataFrame, multimers: DataFrame, most: int = X.PEPTIDE_LENGTH) -> DataFrame:
    """Receptor and presenting units with an interface between the receptor and the MHC or its peptide.

    Units meet through interfaces, never all against all: a chain that touches
    the receptor is of the unit itself, or a short chain that touches both, or
    an auxiliary chain (which alone makes no complex).
    """
    t, p = tcr_units(chains, interfaces), pmhc_units(chains, interfaces, multimers)
    both = sides(interfaces)
    t_ends = t.select("case", "unit", F.explode("tcr_chain_ids").alias("chain"))
    from_tcr = both.join(t_ends, ["case", "chain"]).select("case", "unit", "chain", "other", "buried_area", "num_atom_contacts")
    m_ends = p.select("case", "pmhc_unit", F.explode("mhc_chain_ids").alias("other"))
    short = chains.where(is_peptide(F.col("chain_type"), F.col("length"), most)).select("case", F.col("label_asym_id").alias("other"))
    touched = both.join(m_ends.withColumnRenamed("other", "chain"), ["case", "chain"]).select("case", "pmhc_unit", "other").distinct()
    peptide_of = touched.join(short, ["case", "other"], "left_semi")
    core = from_tcr.join(m_ends, ["case", "other"]).withColumn("part", F.lit("mhc"))
    by_peptide = from_tcr.join(peptide_of, ["case", "other"]).withColumn("part", F.lit("peptide"))
    core = core.unionByName(by_peptide)
    a_ends = p.select("case", "pmhc_unit", F.explode("auxiliary_chain_ids").alias("other"))
    beside = from_tcr.join(a_ends, ["case", "other"]).withColumn("part", F.lit("auxiliary"))
    beside = beside.join(core.select("case", "unit", "pmhc_unit").distinct(), ["case", "unit", "pmhc_unit"], "left_semi")
    relevant = core.unionByName(beside.select(*core.columns)).dropDuplicates(["case", "unit", "pmhc_unit", "chain", "other"])
    found = relevant.groupBy("case", "unit", "pmhc_unit").agg(
        F.count("*").alias("num_tcr_pmhc_interfaces"), F.round(F.sum("buried_area"), 4).alias("contact_score"),
        F.array_sort(F.collect_set(F.when(F.col("part") == "peptide", F.col("other")))).alias("peptide_chain_ids"),
    )
    out = found.join(t, ["case", "unit"]).join(p, ["case", "pmhc_unit"])
    members = F.concat("mhc_chain_ids", "peptide_chain_ids", "auxiliary_chain_ids")
    numbered = out.withColumn("number", F.row_number().over(Window.partitionBy("case").orderBy("unit", "pmhc_unit")))
    asked = numbered.select("case", F.col("number").alias("unit"), F.concat("tcr_chain_ids", members).alias("all_of"), F.lit(None).cast(_TEXTS).alias("any_of"))
    support = supporting_multimers(asked, multimers).withColumnRenamed("unit", "number")
    warned = F.concat("warnings", "pmhc_warnings", F.when(F.size("peptide_chain_ids") == 0, F.array(F.lit("mhc_without_bound_peptide"))).otherwise(F.array().cast(_TEXTS)))
    return numbered.join(support, ["case", "number"], "left").select(
        "case", F.format_string("tcr_pmhc_%03d", "number").alias("complex_id"), "tcr_chain_ids", "tcr_type", "mhc_chain_ids", "mhc_chain_roles", "mhc_class", "peptide_chain_ids", "auxiliary_chain_ids",
        F.size("tcr_chain_ids").alias("num_tcr_chains"), F.size("peptide_chain_ids").alias("num_peptide_chains"), "num_tcr_pmhc_interfaces", "contact_score",
        F.coalesce("supporting", F.array().cast(_TEXTS)).alias("supporting_multimer_ids"), F.array_sort(F.array_distinct(warned)).alias("warnings"),
    )
