"""Chain inventory of structure files: entities, residues, chains, assemblies and entry metadata as joins of categories.

Every function takes tables of one category (``path``, ``row_idx`` and the
category's columns, nulls normalised) and returns tables keyed by ``path``, so
that one plan covers all files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import chains as K
from helixframe.functions import fixed as X
from helixframe.functions.scalars import assembly_order, number_or_null, operations, spaceless, standard_monomer

#: Columns of the categories that the operators read.
CATEGORIES = {
    "entry": ["id"],
    "struct": ["title"],
    "entity": ["id", "type", "pdbx_description"],
    "entity_poly": ["entity_id", "type", "pdbx_seq_one_letter_code_can"],
    "entity_poly_seq": ["entity_id", "num", "mon_id"],
    "pdbx_entity_nonpoly": ["entity_id", "comp_id"],
    "struct_asym": ["id", "entity_id"],
    "chem_comp": ["id", "type", "name", "formula"],
    "pdbx_poly_seq_scheme": ["asym_id", "seq_id", "auth_seq_num", "auth_seq_id", "pdb_seq_num", "pdb_strand_id", "mon_id", "pdb_mon_id", "auth_mon_id"],
    "pdbx_nonpoly_scheme": ["asym_id", "pdb_strand_id"],
    "pdbx_branch_scheme": ["asym_id", "pdb_strand_id"],
    "atom_site": ["label_asym_id", "auth_asym_id", "label_entity_id", "label_comp_id", "label_seq_id", "auth_seq_id", "pdbx_PDB_ins_code", "group_PDB"],
    "pdbx_struct_assembly_gen": ["assembly_id", "asym_id_list", "oper_expression"],
    "exptl": ["method"],
    "exptl_crystal": ["method"],
    "refine": ["ls_d_res_high"],
    "reflns": ["d_resolution_high"],
    "em_3d_reconstruction": ["resolution"],
    "pdbx_audit_revision_history": ["revision_date"],
}


def _last(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Of rows with equal keys the last one's columns."""
    return rows.groupBy(*keys).agg(*[F.max_by(F.struct(*columns), "row_idx").alias("_l")]).select(*keys, *[F.col(f"_l.{c}").alias(c) for c in columns])


def _listed(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Values of each key in order of rows; nulls are left out."""
    pairs = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct("row_idx", F.col(value).alias("v")))))
    return rows.groupBy(*keys).agg(F.transform(pairs, lambda x: x["v"]).alias(name))


def entities(entity: DataFrame, poly: DataFrame, poly_seq: DataFrame, nonpoly: DataFrame) -> DataFrame:
    """One row for each entity that any of the tables names; later tables add what the first lacks."""
    keys = ["path", "entity_id"]
    named = _last(entity.where("id is not null").withColumnRenamed("id", "entity_id"), keys, ["type", "pdbx_description"]).select(
        *keys, F.coalesce("type", F.lit("unknown")).alias("own_type"), F.col("pdbx_description").alias("entity_description")
    )
    polymer = _last(poly.where("entity_id is not null"), keys, ["type", "pdbx_seq_one_letter_code_can"]).select(
        *keys, F.col("type").alias("polymer_type"), spaceless(F.col("pdbx_seq_one_letter_code_can")).alias("sequence"), F.lit(True).alias("_p")
    )
    residues = _listed(poly_seq.where("entity_id is not null"), keys, "mon_id", "residues").withColumn("_s", F.lit(True))
    parts = _listed(nonpoly.where("entity_id is not null"), keys, "comp_id", "parts").withColumn("_n", F.lit(True))
    every = named.join(polymer, keys, "full").join(residues, keys, "full").join(parts, keys, "full")
    made = F.when(F.col("_p") | F.col("_s"), "polymer").when(F.col("_n"), "non-polymer")
    none = F.array().cast("array<string>")
    residue = F.coalesce("residues", none)
    # Components are added once each, after the residues.
    fresh = F.filter(F.array_distinct(F.coalesce("parts", none)), lambda x: ~F.array_contains(residue, x))
    return every.select(
        *keys, F.coalesce("own_type", made).alias("entity_type"), "entity_description", "polymer_type", "sequence", F.concat(residue, fresh).alias("monomer_ids")
    )


def components(chem_comp: DataFrame) -> DataFrame:
    """Type, name and formula of each chemical component."""
    return _last(chem_comp.where("id is not null").withColumnRenamed("id", "comp_id"), ["path", "comp_id"], ["type", "name", "formula"])


def residue_sequence(poly_seq: DataFrame) -> DataFrame:
    """Numbered residues of each entity; rows without a whole number are left out."""
    place = F.col("num").try_cast("int")
    return poly_seq.where("entity_id is not null").select("path", "entity_id", place.alias("label_seq_id"), F.col("mon_id").alias("monomer_id"), "row_idx").where("label_seq_id is not null")


def scheme(poly_scheme: DataFrame) -> DataFrame:
    """Author numbering of each chain's positions; the last row of a position counts."""
    rows = poly_scheme.where("asym_id is not null").select(
        "path", F.col("asym_id").alias("label_asym_id"), F.col("seq_id").try_cast("int").alias("label_seq_id"), "row_idx", "pdb_strand_id",
        F.coalesce("auth_seq_num", "auth_seq_id", "pdb_seq_num").alias("auth_seq_id"), F.coalesce("mon_id", "pdb_mon_id", "auth_mon_id").alias("monomer_id"),
    )
    return _last(rows.where("label_seq_id is not null"), ["path", "label_asym_id", "label_seq_id"], ["auth_seq_id", "pdb_strand_id", "monomer_id"])


def atom_residues(atom_site: DataFrame) -> DataFrame:
    """Distinct residues of each chain with their atoms and first row."""
    rows = atom_site.where("label_asym_id is not null").select(
        "path", "label_asym_id", "label_seq_id", "auth_seq_id", F.col("pdbx_PDB_ins_code").alias("ins_code"), F.col("label_comp_id").alias("comp_id"),
        F.col("group_PDB").alias("group_pdb"), "auth_asym_id", F.col("label_entity_id").alias("entity_id"), "row_idx",
    )
    keys = ["path", "label_asym_id", "label_seq_id", "auth_seq_id", "ins_code", "comp_id", "group_pdb"]
    return rows.groupBy(*keys).agg(
        F.count("*").alias("atoms"), F.min("row_idx").alias("row_idx"), F.min_by("entity_id", "row_idx").alias("entity_id"),
        F.collect_set("auth_asym_id").alias("auth_ids"),
    )


def atom_stats(residues: DataFrame) -> DataFrame:
    """A1: atoms, residues, residue names in order, distinct components in order, resolved positions of each chain."""
    order = F.array_sort(F.collect_list(F.struct("row_idx", "comp_id", F.col("label_seq_id").try_cast("int").alias("place"))))
    names = F.filter(F.transform("_o", lambda x: x["comp_id"]), lambda x: x.isNotNull())
    places = F.filter(F.transform("_o", lambda x: x["place"]), lambda x: x.isNotNull())
    grouped = residues.groupBy("path", "label_asym_id").agg(
        F.sum("atoms").alias("atom_count"), F.count("*").alias("residue_count"), order.alias("_o"), F.flatten(F.collect_set("auth_ids")).alias("_a")
    )
    return grouped.select(
        "path", "label_asym_id", "atom_count", "residue_count", names.alias("residue_monomer_ids"), F.array_distinct(names).alias("component_ids"),
        F.array_sort(F.array_distinct(places)).alias("resolved"), F.array_distinct("_a").alias("auth_ids"),
    )


def author_ids(schemes: list[DataFrame], stats: DataFrame) -> DataFrame:
    """The least author id that any scheme or atom gives a chain, and whether there were several."""
    rows = stats.select("path", "label_asym_id", F.explode("auth_ids").alias("auth_asym_id"))
    for table in schemes:
        rows = rows.unionByName(table.where("asym_id is not null and pdb_strand_id is not null").select("path", F.col("asym_id").alias("label_asym_id"), F.col("pdb_strand_id").alias("auth_asym_id")))
    return rows.groupBy("path", "label_asym_id").agg(F.min("auth_asym_id").alias("auth_asym_id"), (F.countDistinct("auth_asym_id") > 1).alias("several"))


def is_water(entity_type: Column, monomers: Column, found: Column, sequence: Column) -> Column:
    """water by its entity, or as nothing but HOH."""
    only = lambda x: (F.size(x) > 0) & F.forall(x, lambda y: F.upper(F.trim(y)) == "HOH")
    return (F.lower(F.trim(entity_type)) == "water") | only(monomers) | only(found) | F.coalesce(F.upper(F.trim(sequence)) == "HOH", F.lit(False))


def segment_list(places: Column, auth: Column) -> Column:
    """Runs of a sorted array of distinct positions, with author numbers at their ends from a map; neighbours alone are compared."""
    def runs(p: Column) -> Column:
        begins = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
        ends = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) != x + 1))
        return F.arrays_zip(begins.alias("a"), ends.alias("b"))

    # The array is bound once, as a variable, and not made again for every element.
    return F.transform(
        F.transform(F.array(places), runs)[0],
        lambda x: F.struct(
            x["a"].alias("label_seq_start"), x["b"].alias("label_seq_end"), F.try_element_at(auth, x["a"]).alias("auth_seq_start"),
            F.try_element_at(auth, x["b"]).alias("auth_seq_end"), (x["b"] - x["a"] + 1).alias("length"),
        ),
    )


def chain_inventory(cif: dict[str, DataFrame], immune: DataFrame | None = None) -> DataFrame:
    """Annotated chains of each file, waters left out.

    ``immune`` may give (path, label_asym_id, type, subtype, score) of chains by
    their sequences. Auxiliary tables are small beside ``atom_site``, which is
    reduced to residues before it meets them.
    """
    entity = entities(cif["entity"], cif["entity_poly"], cif["entity_poly_seq"], cif["pdbx_entity_nonpoly"])
    stats = atom_stats(atom_residues(cif["atom_site"]))
    auth = author_ids([cif["pdbx_poly_seq_scheme"], cif["pdbx_nonpoly_scheme"], cif["pdbx_branch_scheme"]], stats)
    asym = cif["struct_asym"].where("id is not null and entity_id is not null").select("path", F.col("id").alias("label_asym_id"), "entity_id", "row_idx")
    chain = ["path", "label_asym_id"]
    rows = asym.join(entity, ["path", "entity_id"], "left").join(stats, chain, "left").join(auth, chain, "left")
    none = F.array().cast("array<string>")
    found = F.coalesce("residue_monomer_ids", none)
    rows = rows.withColumns({
        "entity_type": F.coalesce("entity_type", F.lit("unknown")),
        "monomer_ids": F.when(F.size(found) > 0, found).otherwise(F.coalesce("monomer_ids", none)),
        "component_ids": F.coalesce("component_ids", none),
    })
    named = F.col("sequence").isNull() & (F.size("monomer_ids") > 0)
    rows = rows.withColumn("_named", named).withColumn("sequence", F.when(named, F.array_join("monomer_ids", "-")).otherwise(F.col("sequence")))
    rows = rows.where(~is_water(F.col("entity_type"), F.col("monomer_ids"), F.col("component_ids"), F.col("sequence")))
    counted = F.when(F.coalesce("residue_count", F.lit(0)) > 0, F.col("residue_count")).otherwise(F.size("monomer_ids")).cast("int")
    length = F.when(F.col("entity_type") != "polymer", counted).when(F.col("_named"), F.size("monomer_ids")).otherwise(F.length(F.coalesce("sequence", F.lit(""))))

    parts = components(cif["chem_comp"])
    by_id = parts.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("comp_id", F.struct("type", "name", "formula")))).alias("_c"))
    places = scheme(cif["pdbx_poly_seq_scheme"]).groupBy(*chain).agg(F.map_from_entries(F.collect_list(F.struct("label_seq_id", "auth_seq_id"))).alias("_auth"))
    poly = residue_sequence(cif["entity_poly_seq"]).groupBy("path", "entity_id").agg(F.array_sort(F.collect_list(F.struct("label_seq_id", "row_idx", "monomer_id"))).alias("_poly"))
    rows = rows.join(by_id, "path", "left").join(places, chain, "left").join(poly, ["path", "entity_id"], "left")
    of = lambda x: F.try_element_at("_c", x)
    metal = lambda x: K.is_metal(x, of(x)["name"], of(x)["formula"])
    all_metal = (F.size("monomer_ids") > 0) & F.forall("monomer_ids", lambda x: F.coalesce(metal(x), F.lit(False)))
    if immune is None:
        nothing = F.lit(None)
        kind = (nothing.cast("string"), nothing.cast("string"), nothing.cast("double"))
    else:
        rows = rows.join(immune.select(*chain, F.col("type").alias("_it"), F.col("subtype").alias("_is"), F.col("score").alias("_if")), chain, "left")
        kind = (F.col("_it"), F.col("_is"), F.col("_if"))
    rows = rows.withColumn("_k", K.chain_class(F.col("entity_type"), F.col("polymer_type"), F.col("entity_description"), *kind, all_metal))
    is_polymer = F.col("entity_type") == "polymer"
    resolved = F.coalesce("resolved", F.array().cast("array<int>"))
    expected = F.array_sort(F.array_distinct(F.transform(F.coalesce("_poly", F.array().cast("array<struct<label_seq_id:int,row_idx:int,monomer_id:string>>")), lambda x: x["label_seq_id"])))
    odd = F.filter("_poly", lambda x: ~F.coalesce(standard_monomer(F.col("_k.chain_type"), x["monomer_id"]), F.lit(False)))
    special = F.transform(odd, lambda x: F.struct(
        x["label_seq_id"].alias("label_seq_id"), F.try_element_at("_auth", x["label_seq_id"]).alias("auth_seq_id"), x["monomer_id"].alias("monomer_id"),
        of(x["monomer_id"])["type"].alias("chem_comp_type"), of(x["monomer_id"])["name"].alias("chem_comp_name"), F.array_contains(resolved, x["label_seq_id"]).alias("resolved"),
    ))
    detail = F.transform("monomer_ids", lambda x: F.struct(
        x.alias("component_id"), of(x)["type"].alias("chem_comp_type"), of(x)["name"].alias("chem_comp_name"), of(x)["formula"].alias("formula"),
    ))
    empty = lambda kind: F.array().cast(kind)
    segment = "array<struct<label_seq_start:int,label_seq_end:int,auth_seq_start:string,auth_seq_end:string,length:int>>"
    warnings = F.filter(F.array(
        F.when(F.col("several"), "multiple auth_asym_id values found; using the first sorted value"),
        F.when(F.col("auth_asym_id").isNull(), "auth_asym_id not found in scheme categories or atom_site"),
    ), lambda x: x.isNotNull())
    return rows.select(
        "path", "label_asym_id", "auth_asym_id", "entity_id", "entity_type", "entity_description", "polymer_type", F.col("_k.chain_type").alias("chain_type"),
        F.col("_k.subtype").alias("subtype"), "sequence", length.alias("length"), counted.alias("residue_count"), F.coalesce("atom_count", F.lit(0)).cast("int").alias("atom_count"),
        F.col("_k.confidence").alias("annotation_confidence"),
        F.when(is_polymer, segment_list(resolved, F.col("_auth"))).otherwise(empty(segment)).alias("parsed_coordinate_segments"),
        F.when(is_polymer, segment_list(F.array_except(expected, resolved), F.col("_auth"))).otherwise(empty(segment)).alias("unresolved_sequence_segments"),
        F.when(is_polymer, special).alias("special_residue_details"), F.when(~is_polymer, detail).alias("special_component_details"),
        warnings.alias("warnings"),
    )


# Metadata and guards


def case_metadata(cif: dict[str, DataFrame]) -> DataFrame:
    """Method, least resolution (two decimals), least revision date and counts of each file."""
    def values(*named: tuple[str, str]) -> DataFrame:
        rows = [cif[t].select("path", F.lit(i).alias("t"), "row_idx", F.col(c).alias("v")) for i, (t, c) in enumerate(named)]
        out = rows[0]
        for more in rows[1:]:
            out = out.unionByName(more)
        return out.where("v is not null")

    method = values(("exptl", "method"), ("exptl_crystal", "method")).groupBy("path").agg(F.min_by("v", F.struct("t", "row_idx")).alias("experimental_method"))
    fine = values(("refine", "ls_d_res_high"), ("reflns", "d_resolution_high"), ("em_3d_reconstruction", "resolution"))
    fine = fine.groupBy("path").agg(F.round(F.min(number_or_null(F.col("v"))), 2).alias("resolution"))
    date = values(("pdbx_audit_revision_history", "revision_date")).groupBy("path").agg(F.min("v").alias("release_date"))
    entity = entities(cif["entity"], cif["entity_poly"], cif["entity_poly_seq"], cif["pdbx_entity_nonpoly"]).select("path", "entity_id", "entity_type")
    asym = cif["struct_asym"].join(entity, ["path", "entity_id"], "left").groupBy("path").agg(
        F.count_if(F.lower("entity_type") == "polymer").alias("num_polymer_chains"), F.count("id").alias("num_asym_ids")
    )
    gen = cif["pdbx_struct_assembly_gen"].groupBy("path").agg(F.count("*").alias("num_assemblies"))
    out = asym.join(gen, "path", "full").join(method, "path", "full").join(fine, "path", "full").join(date, "path", "full")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select("path", F.coalesce("experimental_method", F.lit("")).alias("experimental_method"), "resolution", F.coalesce("release_date", F.lit("")).alias("release_date"), *map(zero, ("num_polymer_chains", "num_asym_ids", "num_assemblies")))


def preflight(cif: dict[str, DataFrame]) -> DataFrame:
    """polymer chains of each file, and the longest one's length."""
    entity = entities(cif["entity"], cif["entity_poly"], cif["entity_poly_seq"], cif["pdbx_entity_nonpoly"])
    size = F.when(F.length(F.coalesce("sequence", F.lit(""))) > 0, F.length("sequence")).otherwise(F.size("monomer_ids"))
    chains = cif["struct_asym"].where("id is not null and entity_id is not null").join(entity.where(F.lower("entity_type") == "polymer"), ["path", "entity_id"])
    files = cif["struct_asym"].select("path").distinct()
    counted = chains.groupBy("path").agg(F.count("*").alias("n"), F.max(size).alias("m"))
    return files.join(counted, "path", "left").select("path", F.coalesce("n", F.lit(0)).alias("polymer_chain_count"), F.coalesce("m", F.lit(0)).alias("max_polymer_chain_length"))


def size_guard(count: Column, longest: Column, max_chains: int, least_length: int) -> Column:
    """the code for which a file is skipped, or null."""
    return F.when(count > max_chains, "too_many_polymer_chains").when(longest <= least_length, "no_polymer_chain_above_min_length")


def duplicate_chains(struct_asym: DataFrame) -> DataFrame:
    """files (assemblies split before) in which a chain id occurs twice."""
    return struct_asym.where("id is not null").groupBy("path", "id").count().where("count > 1").groupBy("path").agg(F.array_sort(F.collect_list("id")).alias("duplicate_ids"))


# Assemblies


def generators(gen: DataFrame) -> DataFrame:
    """Chains and operations of each generator row; each operation expression once."""
    rows = gen.where("assembly_id is not null and asym_id_list is not null").select(
        "path", "row_idx", "assembly_id", operations(F.col("oper_expression")).alias("ops"),
        F.posexplode(F.filter(F.transform(F.split("asym_id_list", ","), lambda x: F.trim(x)), lambda x: x != "")).alias("place", "chain_id"),
    )
    return rows


def chain_operations(gen: DataFrame) -> DataFrame:
    """Ordered distinct operations of each chain of each assembly, and how many copies they make."""
    chains = F.filter(F.transform(F.split("asym_id_list", ","), lambda x: F.trim(x)), lambda x: x != "")
    rows = gen.where("assembly_id is not null and asym_id_list is not null").select("path", "row_idx", "assembly_id", "oper_expression", F.posexplode(chains).alias("place", "chain_id"))
    # Of equal expressions the first says all, and of equal operations: so many generators of an assembly are many rows, not one list.
    chain = ["path", "assembly_id", "chain_id"]
    once = rows.groupBy(*chain, "oper_expression").agg(F.min(F.struct("row_idx", "place")).alias("_at"))
    each = once.select(*chain, "_at", F.posexplode_outer(operations(F.col("oper_expression"))).alias("_n", "_op"))
    first = each.groupBy(*chain, "_op").agg(F.min(F.struct("_at", "_n")).alias("_at"))
    ordered = F.array_sort(F.collect_list(F.when(F.col("_op").isNotNull(), F.struct("_at", "_op"))))
    return first.groupBy(*chain).agg(F.transform(ordered, lambda x: x["_op"]).alias("operations")).select(*chain, "operations", F.size("operations").alias("copies"))


def polymer_entities(cif: dict[str, DataFrame]) -> DataFrame:
    return entities(cif["entity"], cif["entity_poly"], cif["entity_poly_seq"], cif["pdbx_entity_nonpoly"])


def assembly_sizes(cif: dict[str, DataFrame]) -> DataFrame:
    """A4: atoms that the last generator row of each assembly with any is estimated to make: residues times atoms a residue times copies."""
    own = _last(cif["entity"].where("id is not null").withColumnRenamed("id", "entity_id"), ["path", "entity_id"], ["type"]).select("path", "entity_id", F.coalesce("type", F.lit("")).alias("_own"))
    counted = cif["entity_poly_seq"].where("entity_id is not null and mon_id is not null").groupBy("path", "entity_id").agg(F.count("*").alias("_n"))
    poly = _last(cif["entity_poly"].where("entity_id is not null"), ["path", "entity_id"], ["type", "pdbx_seq_one_letter_code_can"])
    rows = own.join(poly, ["path", "entity_id"], "full").join(counted, ["path", "entity_id"], "left")
    code = F.length(spaceless(F.coalesce("pdbx_seq_one_letter_code_can", F.lit(""))))
    each = F.when(F.lower("type").contains("ribo"), X.ATOMS_PER_RESIDUE["nucleic"]).when(F.lower(F.coalesce("_own", F.lit("polymer"))) == "polymer", X.ATOMS_PER_RESIDUE["protein"]).otherwise(X.ATOMS_PER_RESIDUE["other"])
    has = F.col("type").isNotNull() | F.col("pdbx_seq_one_letter_code_can").isNotNull()
    size = rows.select("path", "entity_id", F.when(has, F.when(code > 0, code).otherwise(F.coalesce("_n", F.lit(0))) * each).otherwise(0).alias("size"))
    chain = cif["struct_asym"].select("path", F.col("id").alias("chain_id"), "entity_id").join(size, ["path", "entity_id"]).select("path", "chain_id", "size")
    total = generators(cif["pdbx_struct_assembly_gen"]).join(chain, ["path", "chain_id"]).groupBy("path", "assembly_id", "row_idx").agg(F.sum(F.col("size") * F.size("ops")).alias("atoms"))
    return total.where("atoms > 0").groupBy("path", "assembly_id").agg(F.max_by("atoms", "row_idx").alias("atoms"))


def within_limit(sizes: DataFrame, most: int) -> DataFrame:
    """F8: assemblies of at most so many atoms, larger ones first; ``dropped`` tells files that lose all."""
    kept = F.col("atoms") <= most
    w = Window.partitionBy("path")
    return sizes.withColumn("dropped", F.count_if(kept).over(w) == 0).where(kept | F.col("dropped")).orderBy("path", F.desc("atoms"), assembly_order(F.col("assembly_id")))


def largest_assembly(cif: dict[str, DataFrame]) -> DataFrame:
    """Per file the assembly with most polymer chains times copies, then the first in order."""
    polymer = polymer_entities(cif).where(F.lower("entity_type") == "polymer").select("path", "entity_id")
    chain = cif["struct_asym"].where("id is not null").join(polymer, ["path", "entity_id"], "left_semi").select("path", F.col("id").alias("chain_id")).distinct()
    every = cif["pdbx_struct_assembly_gen"].where("assembly_id is not null").select("path", "assembly_id").distinct()
    members = generators(cif["pdbx_struct_assembly_gen"]).join(chain, ["path", "chain_id"]).groupBy("path", "assembly_id").agg(F.sum(F.size("ops")).alias("members"))
    scored = every.join(members, ["path", "assembly_id"], "left").withColumn("members", F.coalesce("members", F.lit(0)))
    best = F.min_by("assembly_id", F.struct(-F.col("members"), assembly_order(F.col("assembly_id"))))
    return scored.groupBy("path").agg(best.alias("assembly_id"), F.max("members").alias("members"))


# Coverage of ligands


def coverage(chains: DataFrame, atoms: DataFrame, cutoff: float = X.COVERAGE_CUTOFF) -> DataFrame:
    """Owners of each glycan, small molecule and ion: the chains of the nearest main-chain atoms of its atoms.

    ``atoms`` has path, chain_id, atom_idx, x, y, z. Status: no_coordinates,
    single_owner, multiple_owners or unassigned.
    """
    from helixframe.operators import geometry

    kinds = chains.select("path", F.col("label_asym_id").alias("chain_id"), "chain_type")
    placed = atoms.select("path", F.col("atom_idx").alias("id"), F.col("chain_id").alias("owner"), "x", "y", "z", "chain_id").join(kinds, ["path", "chain_id"])
    main = placed.where(F.col("chain_type").isin(*X.PROTEIN_TYPES, *X.NUCLEIC_TYPES)).drop("chain_id", "chain_type")
    sub = placed.where(F.col("chain_type").isin(*X.SUBORDINATE_TYPES)).drop("chain_id", "chain_type")
    near = geometry.contacts(sub, main, "path", cutoff)
    own = near.groupBy("path", "id").agg(F.min_by("owner_2", F.struct("distance", "owner_2")).alias("o"), F.first("owner").alias("chain_id"))
    owners = own.groupBy("path", "chain_id").agg(F.array_sort(F.collect_set("o")).alias("owners"))
    has = sub.select("path", F.col("owner").alias("chain_id")).distinct().withColumn("_has", F.lit(True))
    out = kinds.where(F.col("chain_type").isin(*X.SUBORDINATE_TYPES)).join(owners, ["path", "chain_id"], "left").join(has, ["path", "chain_id"], "left")
    n = F.size(F.coalesce("owners", F.array().cast("array<string>")))
    status = F.when(F.col("_has").isNull(), "no_coordinates").when(n == 1, "single_owner").when(n > 1, "multiple_owners").otherwise("unassigned")
    return out.select("path", F.col("chain_id").alias("label_asym_id"), "chain_type", F.coalesce("owners", F.array().cast("array<string>")).alias("owners"), status.alias("coverage_status"))


def covered(owners: DataFrame) -> DataFrame:
    """Of each main chain, the glycans and the other components that it alone owns."""
    rows = owners.where("coverage_status = 'single_owner'").select("path", F.col("owners")[0].alias("label_asym_id"), F.col("label_asym_id").alias("part"), "chain_type")
    glycan = F.col("chain_type") == X.GLYCAN
    return rows.groupBy("path", "label_asym_id").agg(
        F.array_sort(F.collect_list(F.when(~glycan, F.col("part")))).alias("covered_nonpolymer_ids"), F.array_sort(F.collect_list(F.when(glycan, F.col("part")))).alias("covered_branched_ids")
    )


def type_counts(chains: DataFrame) -> DataFrame:
    """A2: chains of each type of each file."""
    return chains.groupBy("path", "chain_type").agg(F.count("*").alias("chains"))
