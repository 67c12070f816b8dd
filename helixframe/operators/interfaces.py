"""Interfaces between chain instances: residues, contacts, areas, acceptance, one record for each pair of chains.

Contacts come from equi-joins on grid cells, so that pairs of instances are
never enumerated: two instances meet only where residues of both are near.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import fixed as X
from helixframe.functions.scalars import element_symbol, interface_key, interface_label, residue_id
from helixframe.operators import geometry
from helixframe.operators.tables import written

ATOM = ["case", "instance", "chain_id", "sym_id", "atom_idx", "res_id", "ins_code", "res_name", "atom_name", "element", "x", "y", "z"]


def instance_id(chain: Column, sym: Column | None) -> Column:
    """The chain, with the number of its copy where the structure is an assembly."""
    return chain if sym is None else F.concat(chain, F.lit("@"), (sym + 1).cast("string"))


def residues(atoms: DataFrame, kinds: DataFrame) -> DataFrame:
    """Runs of atoms of one residue in file order, each with its representative atom.

    The representative is the first of P, C4', C3' (nucleic acids) or CA, C1', P
    (others) that the residue has, else its first atom. ``kinds`` has case,
    chain_id and chain_type.
    """
    w = Window.partitionBy("case", "instance").orderBy("atom_idx")
    same = [F.col(c).eqNullSafe(F.lag(c).over(w)) for c in ("res_id", "ins_code", "res_name")]
    starts = F.when(same[0] & same[1] & same[2] & (F.row_number().over(w) > 1), 0).otherwise(1)
    rows = atoms.withColumn("_s", starts).withColumn("residue", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_s")
    rows = rows.join(kinds.select("case", "chain_id", "chain_type"), ["case", "chain_id"], "left")
    nucleic = F.coalesce(F.col("chain_type").isin(*X.NUCLEIC_TYPES), F.lit(False))
    names = {True: ("P", "C4'", "C3'"), False: ("CA", "C1'", "P")}
    rank = lambda n: F.coalesce(*[F.when(F.col("atom_name") == a, i) for i, a in enumerate(names[n])], F.lit(3))
    best = F.min_by(F.struct("x", "y", "z"), F.struct(F.when(nucleic, rank(True)).otherwise(rank(False)), "atom_idx"))
    return rows.groupBy("case", "instance", "chain_id", "sym_id", "residue").agg(
        F.first("res_id").alias("res_id"), F.first("ins_code").alias("ins_code"), F.first("res_name").alias("res_name"), F.min("atom_idx").alias("first_atom"),
        F.max("atom_idx").alias("last_atom"), best.alias("_b"),
    ).select("case", "instance", "chain_id", "sym_id", "residue", "res_id", "ins_code", "res_name", "first_atom", "last_atom", "_b.*")


def boxes(atoms: DataFrame) -> DataFrame:
    """Bounds and centroid of each instance."""
    out = [f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max), ("mid", F.avg))]
    return atoms.groupBy("case", "instance").agg(*out)


def _ends(found: DataFrame) -> DataFrame:
    return found.where("owner < owner_2").select("case", F.col("owner").alias("instance_1"), F.col("owner_2").alias("instance_2"), F.col("id").alias("id_1"), "id_2", "distance")


def residue_contacts(found: DataFrame, cutoff: float = X.RESIDUE_CUTOFF) -> DataFrame:
    """Pairs of residues of two instances whose representatives are within the cutoff."""
    rows = found.select("case", F.col("residue").alias("id"), F.col("instance").alias("owner"), "x", "y", "z")
    return _ends(geometry.contacts(rows, rows, "case", cutoff))


def atom_contacts(atoms: DataFrame, cutoff: float = X.ATOM_CUTOFF) -> DataFrame:
    """Pairs of atoms of two instances within the cutoff."""
    rows = atoms.select("case", F.col("atom_idx").alias("id"), F.col("instance").alias("owner"), "x", "y", "z")
    return _ends(geometry.contacts(rows, rows, "case", cutoff))


def accepted(
    found: DataFrame, atoms: DataFrame, residue_cutoff: float = X.RESIDUE_CUTOFF, atom_cutoff: float = X.ATOM_CUTOFF,
    least_residues: int = X.LEAST_RESIDUE_CONTACTS, least_atoms: int = X.LEAST_ATOM_CONTACTS,
) -> DataFrame:
    """Pairs of instances with enough contacts, and what they measure.

    Contacts within the residue cutoff imply boxes within it, so the boxes'
    distance is reported and filters nothing more.
    """
    pair = ["case", "instance_1", "instance_2"]
    near = residue_contacts(found, residue_cutoff).groupBy(*pair).agg(
        F.count("*").alias("num_residue_contacts"), F.countDistinct("id_1").alias("interface_residue_count_1"),
        F.countDistinct("id_2").alias("interface_residue_count_2"), F.min("distance").alias("_r"),
    ).where(F.col("num_residue_contacts") >= least_residues)
    # Only atoms of instances that are near each other are compared.
    ends = near.select("case", F.explode(F.array("instance_1", "instance_2")).alias("instance")).distinct()
    touch = atom_contacts(atoms.join(ends, ["case", "instance"], "left_semi"), atom_cutoff).groupBy(*pair).agg(F.count("*").alias("num_atom_contacts"), F.min("distance").alias("_a"))
    out = near.join(touch.where(F.col("num_atom_contacts") >= least_atoms), pair)
    bound = boxes(atoms)
    for i in (1, 2):
        out = out.join(bound.toDF("case", f"instance_{i}", *[f"{c}_{i}" for c in bound.columns[2:]]), ["case", f"instance_{i}"])
    side = lambda n, i: [F.col(f"{n}_{c}_{i}") for c in "xyz"]
    gap = geometry.box_gap(side("min", 1), side("max", 1), side("min", 2), side("max", 2))
    middle = F.sqrt(sum(((a - b) * (a - b) for a, b in zip(side("mid", 1), side("mid", 2), strict=True)), F.lit(0.0)))
    return out.select(
        *pair, "num_residue_contacts", "num_atom_contacts", "interface_residue_count_1", "interface_residue_count_2",
        F.round(F.least("_r", "_a"), 4).alias("min_distance"), F.round(middle, 4).alias("centroid_distance"), F.round(gap, 4).alias("bbox_distance"),
    )


def closest_atoms(found: DataFrame, atoms: DataFrame, pairs: DataFrame, cutoff: float = X.RESIDUE_CUTOFF) -> DataFrame:
    """K3: for each pair of residues in contact, their closest atoms; distances to four decimals."""
    rows = residue_contacts(found, cutoff).join(pairs.select("case", "instance_1", "instance_2"), ["case", "instance_1", "instance_2"], "left_semi").drop("distance")
    inside = atoms.join(found.select("case", "instance", "residue", "first_atom", "last_atom"), ["case", "instance"]).where("atom_idx between first_atom and last_atom")
    inside = inside.select("case", "instance", "residue", "atom_idx", "atom_name", "x", "y", "z", residue_id(F.col("res_name"), F.col("res_id"), F.col("ins_code")).alias("name"))
    for i in (1, 2):
        rows = rows.join(inside.toDF("case", f"instance_{i}", f"id_{i}", *[f"{c}_{i}" for c in inside.columns[3:]]), ["case", f"instance_{i}", f"id_{i}"])
    d = F.sqrt(sum(((F.col(f"{c}_1") - F.col(f"{c}_2")) * (F.col(f"{c}_1") - F.col(f"{c}_2")) for c in "xyz"), F.lit(0.0).cast("float")))
    keys = ["case", "instance_1", "id_1", "instance_2", "id_2"]
    best = F.min_by(F.struct("name_1", "atom_name_1", "name_2", "atom_name_2", F.round(d, 4).alias("distance")), F.struct(d, "atom_idx_1", "atom_idx_2"))
    return rows.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


# Areas

# Trigonal carbons without and with hydrogen, and hydroxyl oxygens; their radii, and those of all others, in Angstrom are in ``_radii`` (Tsai et al. 1999).
_BARE = {"ARG CZ", "ASN CG", "ASP CG", "GLN CD", "GLU CD", "HIS CG", "PHE CG", "TRP CG", "TRP CD2", "TRP CE2", "TYR CG", "TYR CZ"}
_AROMATIC = {
    "HIS CD2", "HIS CE1", "PHE CD1", "PHE CD2", "PHE CE1", "PHE CE2", "PHE CZ", "TRP CD1", "TRP CE3", "TRP CZ2", "TRP CZ3", "TRP CH2",
    "TYR CD1", "TYR CD2", "TYR CE1", "TYR CE2",
}
_HYDROXYL = {"SER OG", "THR OG1", "TYR OH"}


#: The probe's radius, and points of a sphere.
PROBE, POINTS = 1.4, 1000
#: Modes of radii: of standard residues, or of elements where a chain of the pair has other residues.
PROTOR, FALLBACK = "ProtOr", "element_vdw_fallback"
#: Neighbours whose cover is measured at once.
COVERS = 1 << 14
_LOST = "case string, mode string, owner string, owner_2 string, lost double"


def sphere(points: int = POINTS) -> np.ndarray:
    """Points spread over a unit sphere along a spiral."""
    k = np.arange(points) + 0.5
    polar, turn = np.arccos(1 - 2 * k / points), np.pi * (1 + 5**0.5) * k
    return np.stack([np.cos(turn) * np.sin(polar), np.sin(turn) * np.sin(polar), np.cos(polar)], 1)


def covers(spots: np.ndarray, apart: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which points of an atom's sphere a neighbour covers, as bitmaps: a row for each (offset of the neighbour, radii with the probe).

    A point s of the sphere of radius R is within S of a neighbour at offset d
    where 2 R s.d > R**2 + d.d - S**2: one product of matrices for all of them.
    """
    out = np.empty((len(apart), (len(spots) + 7) // 8), np.uint8)
    for lo in range(0, len(apart), COVERS):
        d, r, s = apart[lo : lo + COVERS], own[lo : lo + COVERS], other[lo : lo + COVERS]
        inside = 2 * r[:, None] * (d @ spots.T) > (r * r + (d * d).sum(1) - s * s)[:, None]
        out[lo : lo + COVERS] = np.packbits(inside, axis=1)
    return out


def _lost(batches):
    """What each atom loses to each other instance: the points that are free in its own chain and covered by that one."""
    spots = sphere()
    for batch in batches:
        near = batch.column("near")
        flat = near.flatten()
        count = np.diff(np.asarray(near.offsets))
        atom = np.repeat(np.arange(batch.num_rows), count)
        value = lambda c: np.asarray(flat.field(c), float)  # noqa: E731, B023
        place = np.stack([np.asarray(batch.column(c), float) for c in "xyz"], 1)
        radius = np.asarray(batch.column("r"), float) + PROBE
        owners = flat.field("owner_2").dictionary_encode()
        code, names = np.asarray(owners.indices, np.int64), owners.dictionary.to_pylist()
        own = np.array([names.index(x) if x in names else -1 for x in batch.column("owner").to_pylist()], np.int64)
        cover = covers(spots, np.stack([value(c) for c in "xyz"], 1) - place[atom], radius[atom], value("r") + PROBE)
        order = np.lexsort([code, atom])
        atom, code, cover = atom[order], code[order], cover[order]
        at = np.flatnonzero(np.concatenate([np.ones(min(1, len(atom)), bool), (atom[1:] != atom[:-1]) | (code[1:] != code[:-1])]))
        merged = np.bitwise_or.reduceat(cover, at, 0) if len(at) else cover
        atom, code = atom[at], code[at]
        hidden = np.zeros((batch.num_rows, cover.shape[1]), np.uint8)
        mine = code == own[atom]
        hidden[atom[mine]] = merged[mine]
        bits = np.bitwise_count(merged[~mine] & ~hidden[atom[~mine]]).sum(1)
        area = 4 * np.pi * radius[atom[~mine]] ** 2 * bits / len(spots)
        rows = pa.array(atom[~mine])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(rows) for c in ("case", "mode", "owner")), pa.array([names[k] for k in code[~mine].tolist()], pa.string()), pa.array(area, pa.float64())], names=[x.split()[0] for x in _LOST.split(", ")]
        )


def _radii(atoms: DataFrame) -> DataFrame:
    """Atoms of finite places with their radius by residue and by element, null where there is none."""
    symbol = element_symbol(F.col("element"), F.col("atom_name"))
    # Radii hang on a residue's atom by its first letter; the exceptions are listed by name.
    residue, atom = F.col("res_name"), F.col("atom_name")
    name, first = F.concat_ws(" ", residue, atom), F.substring(atom, 1, 1)
    carbon = F.when((atom == "C") | name.isin(*_BARE), 1.61).when(name.isin(*_AROMATIC), 1.76).otherwise(1.88)
    oxygen = F.when(name.isin(*_HYDROXYL) | (atom == "OXT"), 1.46).otherwise(1.42)
    united = F.when(first == "C", carbon).when(first == "N", 1.64).when(first == "S", 1.77).when(first == "O", oxygen)
    table = F.create_map(*[F.lit(v) for pair in sorted(X.RADII.items()) for v in pair])
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in "xyz"]
    rows = atoms.where(finite[0] & finite[1] & finite[2] & ~symbol.isin("H", "D", "T"))
    return rows.select(
        "case", F.col("instance").alias("owner"), F.col("atom_idx").alias("id"), *[F.col(c).cast("double").alias(c) for c in "xyz"],
        F.when(residue.isin(*X.AMINO_ACIDS), united).alias("united"), F.try_element_at(table, symbol).cast("double").alias("plain"),
    )


def areas(pairs: DataFrame, atoms: DataFrame) -> DataFrame:
    """K4-K6: area that each side of a pair of instances loses, and buries.

    Atoms within reach of another instance get a bitmap of the points of their
    sphere that their own chain leaves free, once, whatever the number of their
    chain's pairs; what they lose to an instance is the part of it that the
    instance's atoms near them cover. Work and rows are linear in contacts.
    """
    key = ["case", "instance_1", "instance_2"]
    sized = _radii(atoms)
    chain = sized.groupBy("case", "owner").agg(F.count("*").alias("n"), F.count("united").alias("u"), F.count("plain").alias("p"))
    named = pairs.select(*key)
    for i in (1, 2):
        named = named.join(chain.select("case", F.col("owner").alias(f"instance_{i}"), *[F.col(c).alias(f"{c}{i}") for c in "nup"]), ["case", f"instance_{i}"], "left").na.fill(0)
    standard = (F.col("n1") == F.col("u1")) & (F.col("n2") == F.col("u2"))
    named = written(named.withColumn("mode", F.when(standard, PROTOR).otherwise(FALLBACK)))
    both = named.select("case", "mode", F.col("instance_1").alias("owner"), F.col("instance_2").alias("owner_2")).union(named.select("case", "mode", "instance_2", "instance_1"))
    modes = both.select("case", "owner", "mode").distinct()
    placed = sized.join(modes, ["case", "owner"]).withColumn("r", F.when(F.col("mode") == PROTOR, F.col("united")).otherwise(F.col("plain"))).where("r is not null")
    placed = written(placed.select(F.concat_ws("#", "mode", "case").alias("k"), "case", "mode", "owner", "id", "x", "y", "z", "r"))
    reach = 2 * (max(1.88, *X.RADII.values()) + PROBE)
    touching = F.sqrt(sum(((F.col(c) - F.col(f"{c}_2")) * (F.col(c) - F.col(f"{c}_2")) for c in "xyz"), F.lit(0.0))) < F.col("r") + F.col("r_2") + 2 * PROBE
    near = geometry.near_rows(placed, placed.select("k", "owner", "id", "x", "y", "z", "r"), "k", reach).where(touching & ((F.col("owner") != F.col("owner_2")) | (F.col("id") != F.col("id_2"))))
    wanted = both.select(F.concat_ws("#", "mode", "case").alias("k"), "owner", "owner_2", F.lit(True).alias("_w"))
    near = near.join(wanted, ["k", "owner", "owner_2"], "left").where(F.col("_w") | (F.col("owner") == F.col("owner_2")))
    item = F.struct("owner_2", *[F.col(f"{c}_2").alias(c) for c in "xyz"], F.col("r_2").alias("r"))
    lists = near.groupBy("case", "mode", "owner", "id", "x", "y", "z", "r").agg(F.collect_list(item).alias("near"), F.max("_w").alias("_w")).where("_w").drop("_w", "id")
    lost = lists.mapInArrow(_lost, _LOST).groupBy("case", "mode", "owner", "owner_2").agg(F.sum("lost").alias("lost"))
    lost = written(lost)
    out = named
    for i in (1, 2):
        out = out.join(lost.select("case", "mode", F.col("owner").alias(f"instance_{i}"), F.col("owner_2").alias(f"instance_{3 - i}"), F.col("lost").alias(f"lost_{i}")), ["mode", *key], "left")
    plain = F.col("mode") == FALLBACK
    none = F.when(plain, (F.col("p1") == 0) | (F.col("p2") == 0)).otherwise((F.col("n1") == 0) | (F.col("n2") == 0))
    fewer = plain & ((F.col("p1") < F.col("n1")) | (F.col("p2") < F.col("n2")))
    told = F.array(F.when(plain, "interface_area_used_element_vdw_fallback"), F.when(fewer, "interface_area_dropped_unsupported_atoms_for_fallback"), F.when(none, "interface_area_not_computed_after_filtering"))
    one, two = (F.coalesce(f"lost_{i}", F.lit(0.0)) for i in (1, 2))
    return out.select(
        *key, F.round(one, 4).alias("delta_sasa_1"), F.round(two, 4).alias("delta_sasa_2"), F.round(F.greatest((one + two) / 2, F.lit(0.0)), 4).alias("buried_area"),
        F.when(none, "not_computed").otherwise(F.col("mode")).alias("area_method"), F.filter(told, lambda x: x.isNotNull()).alias("warnings"),
    )


# Records


def interface_records(measured: DataFrame, chains: DataFrame, mode: str, assembly: str | None = None) -> DataFrame:
    """A record for each pair of instances, with the chains of both sides.

    ``measured`` joins ``accepted`` and ``areas``; ``chains`` has case,
    label_asym_id, auth_asym_id, entity_id, chain_type and residue_count.
    """
    out = measured
    for i in (1, 2):
        parts = F.split(f"instance_{i}", "@")
        out = out.withColumn(f"label_asym_id_{i}", parts[0]).withColumn(f"sym_id_{i}", F.coalesce(F.try_element_at(parts, F.lit(2)).cast("int") - 1, F.lit(0)))
        own = chains.select("case", F.col("label_asym_id").alias(f"label_asym_id_{i}"), *[F.col(c).alias(f"{c}_{i}") for c in ("auth_asym_id", "entity_id", "chain_type", "residue_count")])
        out = out.join(own, ["case", f"label_asym_id_{i}"])
        ratio = F.round(F.col(f"interface_residue_count_{i}") / F.greatest(F.col(f"residue_count_{i}"), F.lit(1)), 6)
        out = out.withColumn(f"interface_residue_ratio_{i}", ratio).drop(f"residue_count_{i}")
    same = F.col("entity_id_1") == F.col("entity_id_2")
    mean = (F.col("interface_residue_count_1") + F.col("interface_residue_count_2")) / 2
    per = lambda c: F.round(F.when(mean > 0, F.col(c) / mean).otherwise(0.0), 4)
    any_of = lambda kinds: F.col("chain_type_1").isin(*kinds) | F.col("chain_type_2").isin(*kinds)
    antibody = F.col("chain_type_1").contains("antibody") | F.col("chain_type_2").contains("antibody")
    return out.withColumns({
        "assembly_mode": F.lit(mode), "assembly_id": F.lit(assembly).cast("string"), "is_same_entity": same,
        "interface_label": interface_label(F.col("chain_type_1"), F.col("chain_type_2"), same), "contains_antibody_unit": antibody,
        "contains_tcr_pmhc_unit": any_of(X.TCR_PMHC_TYPES), "mean_interface_residue_count": F.round(mean, 4),
        "buried_area_per_interface_residue": per("buried_area"), "atom_contacts_per_interface_residue": per("num_atom_contacts"), "residue_contacts_per_interface_residue": per("num_residue_contacts"),
    })


def rank() -> Column:
    """Better interfaces are larger."""
    return F.struct("buried_area", "num_atom_contacts", "num_residue_contacts", (-F.col("min_distance")).alias("near"))


def deduplicated(records: DataFrame) -> DataFrame:
    """Of the copies of an interface the best, with its distinct supporting pairs of instances."""
    side = lambda i: F.struct(F.col(f"label_asym_id_{i}").alias("chain"), F.col(f"entity_id_{i}").alias("entity"))
    key = interface_key(F.col("assembly_mode"), F.col("assembly_id"), side(1), side(2), F.col("interface_label"), F.col("is_same_entity"))
    tie = F.struct(rank().alias("rank"), F.negative(F.xxhash64("instance_1", "instance_2")).alias("tie"))
    rows = records.withColumn("_key", key)
    pair = F.array_sort(F.collect_set(F.struct("instance_1", "instance_2")))
    best = rows.groupBy("case", "_key").agg(F.max_by(F.struct(*records.columns), tie).alias("_b"), pair.alias("supporting_instance_pairs"), F.count("*").alias("_n"))
    own = F.coalesce("_b.warnings", F.array().cast("array<string>")) if "warnings" in records.columns else F.array().cast("array<string>")
    warned = F.when(F.col("_n") > 1, F.array_union(own, F.array(F.lit("deduplicated_over_instance_pairs")))).otherwise(own)
    kept = [F.col(f"_b.{c}").alias(c) for c in records.columns if c != "warnings"]
    return best.select(*kept, F.size("supporting_instance_pairs").alias("num_supporting_instance_pairs"), "supporting_instance_pairs", warned.alias("warnings"))


def bound_chains(records: DataFrame) -> DataFrame:
    """The chains that each chain has interfaces with."""
    ends = [records.select("case", F.col(f"label_asym_id_{i}").alias("label_asym_id"), F.col(f"label_asym_id_{3 - i}").alias("other")) for i in (1, 2)]
    return ends[0].union(ends[1]).where("label_asym_id <> other").groupBy("case", "label_asym_id").agg(F.array_sort(F.collect_set("other")).alias("bound_chain_ids"))


def identify(atoms: DataFrame, chains: DataFrame, mode: str = "asymmetric_unit", assembly: str | None = None) -> DataFrame:
    """J7 whole: deduplicated interfaces of the polymer chains of all cases. ``atoms`` has the columns of ``ATOM``."""
    polymer = chains.where(F.col("chain_type").isin(*X.POLYMER_TYPES))
    kept = atoms.join(polymer.select("case", F.col("label_asym_id").alias("chain_id")), ["case", "chain_id"], "left_semi")
    kinds = polymer.select("case", F.col("label_asym_id").alias("chain_id"), "chain_type")
    pairs = accepted(residues(kept, kinds), kept)
    measured = pairs.join(areas(pairs, kept), ["case", "instance_1", "instance_2"])
    return deduplicated(interface_records(measured, polymer, mode, assembly))
