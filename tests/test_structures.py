"""Structure files to chains, assemblies, interfaces and complexes."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import complexes, immune, interfaces, inventory
from helixframe.sources import mmcif

FILE = """data_TEST
_entry.id 1ABC
loop_
_entity.id
_entity.type
_entity.pdbx_description
1 polymer 'T cell receptor alpha chain'
2 non-polymer ZINC
3 water water
4 polymer DNA
loop_
_entity_poly.entity_id
_entity_poly.type
_entity_poly.pdbx_seq_one_letter_code_can
1 polypeptide(L)
;GS
A
;
4 polydeoxyribonucleotide ?
loop_
_entity_poly_seq.entity_id
_entity_poly_seq.num
_entity_poly_seq.mon_id
1 1 GLY
1 2 MSE
1 3 ALA
4 1 DA
4 2 DC
loop_
_pdbx_entity_nonpoly.entity_id
_pdbx_entity_nonpoly.comp_id
2 ZN
5 ATP
loop_
_struct_asym.id
_struct_asym.entity_id
A 1
B 1
C 2
W 3
D 4
loop_
_chem_comp.id
_chem_comp.type
_chem_comp.name
_chem_comp.formula
MSE 'L-peptide linking' SELENOMETHIONINE 'C5 H11 N O2 Se'
ZN non-polymer 'ZINC ION' Zn
loop_
_pdbx_poly_seq_scheme.asym_id
_pdbx_poly_seq_scheme.seq_id
_pdbx_poly_seq_scheme.auth_seq_num
_pdbx_poly_seq_scheme.pdb_strand_id
A 1 101 H
A 2 102 H
A 3 103 H
loop_
_pdbx_struct_assembly_gen.assembly_id
_pdbx_struct_assembly_gen.oper_expression
_pdbx_struct_assembly_gen.asym_id_list
1 1 A,B
2 1,2 A,B,C
10 (1)(2)(3) A
loop_
_pdbx_struct_oper_list.id
_pdbx_struct_oper_list.matrix[1][1]
_pdbx_struct_oper_list.matrix[1][2]
_pdbx_struct_oper_list.matrix[1][3]
_pdbx_struct_oper_list.matrix[2][1]
_pdbx_struct_oper_list.matrix[2][2]
_pdbx_struct_oper_list.matrix[2][3]
_pdbx_struct_oper_list.matrix[3][1]
_pdbx_struct_oper_list.matrix[3][2]
_pdbx_struct_oper_list.matrix[3][3]
_pdbx_struct_oper_list.vector[1]
_pdbx_struct_oper_list.vector[2]
_pdbx_struct_oper_list.vector[3]
1 1 0 0 0 1 0 0 0 1 1 0 0
2 0 -1 0 1 0 0 0 0 1 10 0 0
3 1 0 0 0 1 0 0 0 1 100 0 0
loop_
_exptl.method
'X-RAY DIFFRACTION'
loop_
_refine.ls_d_res_high
2.456
loop_
_em_3d_reconstruction.resolution
3.1
loop_
_pdbx_audit_revision_history.revision_date
2021-05-01
2020-01-02
loop_
_atom_site.group_PDB
_atom_site.id
_atom_site.type_symbol
_atom_site.label_atom_id
_atom_site.label_alt_id
_atom_site.label_comp_id
_atom_site.label_asym_id
_atom_site.label_entity_id
_atom_site.label_seq_id
_atom_site.auth_seq_id
_atom_site.auth_asym_id
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
_atom_site.pdbx_PDB_model_num
ATOM 1 N N . GLY A 1 1 101 H 0 0 0 1
ATOM 2 C CA . GLY A 1 1 101 H 1 0 0 1
ATOM 3 H H . GLY A 1 1 101 H 1 1 0 1
ATOM 4 C CA . ALA A 1 3 103 H 5 0 0 1
HETATM 5 ZN ZN . ZN C 2 . 301 H 2 1 0 1
HETATM 6 O O . HOH W 3 . 401 H 9 9 9 1
"""


@pytest.fixture(scope="module")
def cif(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cif")
    (root / "1abc.cif").write_text(FILE)
    found = mmcif.stored(mmcif.scan(spark, str(root)), str(root / "items"))
    return found, mmcif.categories(found, inventory.CATEGORIES)


def test_inventory(cif):
    rows = {r.label_asym_id: r for r in inventory.chain_inventory(cif[1]).collect()}
    assert sorted(rows) == ["A", "B", "C", "D"]
    a, b, c, d = (rows[k] for k in "ABCD")
    assert (a.chain_type, a.subtype, a.sequence, a.length, a.auth_asym_id, a.residue_count, a.atom_count) == ("TCR chain", "alpha", "GSA", 3, "H", 2, 4)
    assert [tuple(s) for s in a.parsed_coordinate_segments] == [(1, 1, "101", "101", 1), (3, 3, "103", "103", 1)]
    assert [tuple(s) for s in a.unresolved_sequence_segments] == [(2, 2, "102", "102", 1)]
    assert [(s.label_seq_id, s.monomer_id, s.chem_comp_name, s.resolved) for s in a.special_residue_details] == [(2, "MSE", "SELENOMETHIONINE", False)]
    assert (b.residue_count, b.atom_count, b.warnings) == (3, 0, ["auth_asym_id not found in scheme categories or atom_site"])
    assert (c.chain_type, c.length, [x.component_id for x in c.special_component_details]) == ("metal ion", 1, ["ZN"])
    assert (d.chain_type, d.sequence, d.length) == ("DNA chain", "DA-DC", 2)
    named = {r.entity_id: (r.entity_type, r.monomer_ids) for r in inventory.polymer_entities(cif[1]).collect()}
    assert named["5"] == ("non-polymer", ["ATP"]) and named["1"][1] == ["GLY", "MSE", "ALA"]


def test_metadata_and_assemblies(cif):
    m = inventory.case_metadata(cif[1]).first()
    assert (m.experimental_method, m.resolution, m.release_date, m.num_polymer_chains, m.num_asym_ids, m.num_assemblies) == ("X-RAY DIFFRACTION", 2.46, "2020-01-02", 3, 5, 3)
    p = inventory.preflight(cif[1]).first()
    assert (p.polymer_chain_count, p.max_polymer_chain_length) == (3, 3)
    assert {r.assembly_id: r.atoms for r in inventory.assembly_sizes(cif[1]).collect()} == {"1": 48, "2": 96, "10": 24}
    assert inventory.largest_assembly(cif[1]).first().assembly_id == "2"
    kept = inventory.within_limit(inventory.assembly_sizes(cif[1]), 50).collect()
    assert [(r.assembly_id, r.dropped) for r in kept] == [("1", False), ("10", False)]
    ops = {(r.assembly_id, r.chain_id): (r.operations, r.copies) for r in inventory.chain_operations(cif[1]["pdbx_struct_assembly_gen"]).collect()}
    assert ops["2", "C"] == (["1", "2"], 2) and ops["10", "A"] == (["1x2x3"], 1)
    assert mmcif.column_values(cif[0], "entity", "id").first()["values"] == ["1", "2", "3", "4"]


def test_three_factors(cif):
    moved = {r.atom_idx: (r.x, r.y) for r in mmcif.assembly_atoms(cif[0], "10").collect()}
    # 100 more, then a quarter turn and 10 more, then 1 more.
    assert moved[1] == (pytest.approx(11.0), pytest.approx(101.0)) and len(moved) == 3


def test_coverage(cif):
    chains = inventory.chain_inventory(cif[1])
    owners = inventory.coverage(chains, mmcif.atoms(cif[0])).collect()
    assert [(r.label_asym_id, r.owners, r.coverage_status) for r in owners] == [("C", ["A"], "single_owner")]
    held = inventory.covered(inventory.coverage(chains, mmcif.atoms(cif[0]))).first()
    assert (held.label_asym_id, held.covered_nonpolymer_ids, held.covered_branched_ids) == ("A", ["C"], [])


def chains_of(spark, rows):
    schema = "case string, label_asym_id string, auth_asym_id string, entity_id string, entity_description string, chain_type string, subtype string, length int, residue_count int, unit_type string, covered_nonpolymer_ids array<string>, covered_branched_ids array<string>"
    return spark.createDataFrame([("c", a, a.lower(), e, d, t, s, n, n, "", [], []) for a, e, d, t, s, n in rows], schema)


def test_interfaces_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for chain in "AB":
        for sym in (0, 1):
            base = rng.normal(size=3) * 3
            for residue in range(12):
                for atom in ("N", "CA", "CB"):
                    x, y, z = (base + rng.normal(size=3) * 4).astype(np.float32).tolist()
                    rows.append(("c", f"{chain}@{sym + 1}", chain, sym, n, residue, "", "ALA", atom, atom[0], x, y, z))
                    n += 1
    atoms = spark.createDataFrame(rows, "case string, instance string, chain_id string, sym_id int, atom_idx int, res_id int, ins_code string, res_name string, atom_name string, element string, x float, y float, z float")
    chains = chains_of(spark, [("A", "1", "", "other protein chain", "", 12), ("B", "1", "", "other protein chain", "", 12)])
    kinds = chains.select("case", F.col("label_asym_id").alias("chain_id"), "chain_type")
    got = {(r.instance_1, r.instance_2): r for r in interfaces.accepted(interfaces.residues(atoms, kinds), atoms).collect()}
    want = {}
    names = sorted({r[1] for r in rows})
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            one, two = ([r for r in rows if r[1] == x] for x in (a, b))
            far = lambda p, q: float(np.linalg.norm(np.array(p[-3:]) - np.array(q[-3:])))
            ca = [(p, q) for p in one for q in two if p[8] == q[8] == "CA" and far(p, q) <= 8]
            near = [far(p, q) for p in one for q in two if far(p, q) <= 5]
            if len(ca) >= 3 and len(near) >= 20:
                want[a, b] = (len(ca), len(near), len({p[5] for p, _ in ca}), len({q[5] for _, q in ca}))
    assert {k: (r.num_residue_contacts, r.num_atom_contacts, r.interface_residue_count_1, r.interface_residue_count_2) for k, r in got.items()} == want and want
    whole = interfaces.identify(atoms, chains, "largest_assembly", "1").collect()
    assert {(r.label_asym_id_1, r.label_asym_id_2) for r in whole} == {tuple(sorted((a[0], b[0]))) for a, b in want}
    for r in whole:
        same = [k for k in want if tuple(sorted((k[0][0], k[1][0]))) == (r.label_asym_id_1, r.label_asym_id_2)]
        assert r.num_supporting_instance_pairs == len(same) and r.buried_area > 0 and r.is_same_entity
        assert ("deduplicated_over_instance_pairs" in r.warnings) == (len(same) > 1)
    close = interfaces.closest_atoms(interfaces.residues(atoms, kinds), atoms, interfaces.accepted(interfaces.residues(atoms, kinds), atoms)).collect()
    assert len(close) == sum(v[0] for v in want.values()) and all(r.distance <= 8 for r in close)


def lost_area(places, radii, others, other_radii):
    """What one set of atoms loses beside another, point by point."""
    spots, lost = interfaces.sphere(), 0.0
    for i, (x, r) in enumerate(zip(places, radii, strict=True)):
        at = x + (r + interfaces.PROBE) * spots
        covered = lambda c, s: (((at[:, None] - c) ** 2).sum(2) < (s + interfaces.PROBE) ** 2).any(1) if len(c) else np.zeros(len(at), bool)  # noqa: E731, B023
        keep = np.arange(len(places)) != i
        alone = ~covered(places[keep], radii[keep])
        lost += 4 * math.pi * (r + interfaces.PROBE) ** 2 * (alone & covered(others, other_radii)).mean()
    return lost


def test_covered_points_of_two_spheres():
    # Two equal spheres at a distance d: each loses a cap of 2 pi r (r - d / 2).
    r, d = 1.7 + 1.4, 3.0
    bits = interfaces.covers(interfaces.sphere(4000), np.array([[d, 0, 0]]), np.array([r]), np.array([r]))
    assert 4 * math.pi * r * r * np.bitwise_count(bits).sum() / 4000 == pytest.approx(2 * math.pi * r * (r - d / 2), rel=0.01)


def test_areas_by_bitmaps(spark):
    """Chains of several pairs, one with an atom of no standard residue, one without known elements, one far away."""
    rng = np.random.default_rng(4)
    rows, chains = [], {}
    for chain, middle in (("A", (0, 0, 0)), ("B", (8, 0, 0)), ("C", (0, 8, 0)), ("D", (0, 0, 8)), ("E", (0, -8, 0)), ("F", (200, 0, 0))):
        for i in range(40):
            x = np.float32(rng.normal(size=3) * 2.5 + middle)
            kind = [("ALA", "CA", "C", 1.88, 1.70), ("SER", "OG", "O", 1.46, 1.52), ("GLY", "N", "N", 1.64, 1.55), ("PHE", "CZ", "C", 1.76, 1.70), ("ASP", "C", "C", 1.61, 1.70), ("CYS", "SG", "S", 1.77, 1.80)][i % 6]
            if chain == "D" and i == 0:
                kind = ("XYZ", "C1", "C", None, 1.70)
            if chain == "E":
                kind = ("XYZ", "Q1", "QQ", None, None)
            rows.append(("c", chain, chain, 0, i + 100 * ord(chain), i, "", *kind[:3], *map(float, x)))
            chains.setdefault(chain, []).append((x.astype(float), kind[3], kind[4]))
        rows.append(("c", chain, chain, 0, 99 + 100 * ord(chain), 99, "", "ALA", "CA", "C", float("nan"), 0.0, 0.0))
    atoms = spark.createDataFrame(rows, "case string, instance string, chain_id string, sym_id int, atom_idx int, res_id int, ins_code string, res_name string, atom_name string, element string, x float, y float, z float")
    pairs = spark.createDataFrame([("c", a, b) for a, b in ("AB", "AC", "AD", "BC", "AE", "AF")], "case string, instance_1 string, instance_2 string")
    got = {(r.instance_1, r.instance_2): r for r in interfaces.areas(pairs, atoms).collect()}
    assert set(got) == {tuple(x) for x in ("AB", "AC", "AD", "BC", "AE", "AF")}
    for (a, b), r in got.items():
        mode = 2 if "D" in (a, b) or "E" in (a, b) else 1
        one, two = ([(x[0], x[mode]) for x in chains[c] if x[mode] is not None] for c in (a, b))
        sides = [(np.array([x[0] for x in s]).reshape(-1, 3), np.array([x[1] for x in s])) for s in (one, two)]
        want = (0.0, 0.0) if not len(one) or not len(two) else (lost_area(*sides[0], *sides[1]), lost_area(*sides[1], *sides[0]))
        assert (r.delta_sasa_1, r.delta_sasa_2, r.buried_area) == pytest.approx((*want, sum(want) / 2), abs=2e-4)
        assert r.area_method == ("not_computed" if b == "E" else "element_vdw_fallback" if b == "D" else "ProtOr")
    assert got["A", "B"].buried_area > 10 and got["A", "F"].buried_area == 0 and got["A", "D"].warnings == ["interface_area_used_element_vdw_fallback"]
    assert got["A", "E"].warnings == ["interface_area_used_element_vdw_fallback", "interface_area_dropped_unsupported_atoms_for_fallback", "interface_area_not_computed_after_filtering"]


def face(a, ta, b, tb, area, atoms=30, residues=5):
    return ("c", a, ta, b, tb, float(area), atoms, residues)


FACES = "case string, label_asym_id_1 string, chain_type_1 string, label_asym_id_2 string, chain_type_2 string, buried_area double, num_atom_contacts int, num_residue_contacts int"
HEAVY, LIGHT, OTHER = "antibody heavy chain", "antibody light chain", "other protein chain"


def test_antibody_complexes(spark):
    chains = chains_of(spark, [("H1", "1", "", HEAVY, "heavy", 220), ("H2", "1", "", HEAVY, "heavy", 220), ("L1", "2", "", LIGHT, "light", 210), ("L2", "2", "", LIGHT, "light", 210),
                               ("V", "4", "", HEAVY, "VHH", 120), ("X", "3", "", OTHER, "protein", 90), ("Y", "3", "", OTHER, "protein", 90), ("Z", "5", "", OTHER, "protein", 50)])
    faces = spark.createDataFrame([
        face("H1", HEAVY, "L1", LIGHT, 900), face("L2", LIGHT, "H1", HEAVY, 950), face("H2", HEAVY, "L2", LIGHT, 940), face("H1", HEAVY, "X", OTHER, 300), face("Y", OTHER, "H1", HEAVY, 500),
        face("L2", LIGHT, "Z", OTHER, 600), face("V", HEAVY, "Z", OTHER, 100), face("H1", HEAVY, "H2", HEAVY, 700),
    ], FACES)
    multimers = spark.createDataFrame([("c", "m1", ["H1", "L2", "Y"]), ("c", "m2", ["H1", "Y"])], "case string, multimer_id string, member_chain_ids array<string>")
    pairs = complexes.heavy_light_pairs(chains, faces)
    assert [(r.heavy, r.light) for r in pairs.collect()] == [("H1", "L2")]
    assert {(r.label_asym_id, r.is_true_heavy_only) for r in complexes.heavy_only(chains, pairs).collect()} == {("H1", False), ("H2", True), ("V", True)}
    got = {r.antibody_heavy_chain: r for r in complexes.antibody_complexes(chains, faces, multimers).collect()}
    assert sorted(got) == ["H1", "V"]
    one = got["H1"]
    assert (one.complex_id, one.antibody_unit_type, one.antibody_light_chain, one.antigen_chain_ids) == ("ab_ag_001", "paired_heavy_light", "L2", ["Y", "Z"])
    assert (one.contact_score, one.num_antibody_antigen_interfaces, one.supporting_multimer_ids, one.warnings) == (1400.0, 3, ["m1"], ["same_entity_antigen_copies_collapsed"])
    assert [s.all_antigen_chain_ids for s in one.antigen_interface_summaries] == [["Y", "X"], ["Z"]]
    assert (got["V"].antibody_unit_type, got["V"].antigen_chain_ids, got["V"].warnings) == ("VHH", ["Z"], [])


def test_receptor_complexes(spark):
    tcr, mhc, aux = "TCR chain", "MHC heavy chain", "beta2m or auxiliary immune chain"
    chains = chains_of(spark, [("A", "1", "", tcr, "alpha", 200), ("B", "2", "", tcr, "beta", 240), ("G", "3", "", tcr, "gamma", 200), ("M", "4", "HLA class I antigen A", mhc, "class_i", 275),
                               ("N", "5", "HLA class II DR alpha chain", mhc, "class_ii", 180), ("O", "6", "HLA class II DR beta chain", mhc, "class_ii", 190),
                               ("U", "7", "beta-2-microglobulin", aux, "beta2m", 99), ("P", "8", "", OTHER, "protein", 9), ("Q", "9", "", OTHER, "protein", 300)])
    faces = spark.createDataFrame([
        face("A", tcr, "B", tcr, 800), face("A", tcr, "M", mhc, 400), face("B", tcr, "P", OTHER, 150), face("M", mhc, "P", OTHER, 700), face("M", mhc, "U", aux, 900),
        face("N", mhc, "O", mhc, 1200), face("G", tcr, "U", aux, 120), face("Q", OTHER, "B", tcr, 500),
    ], FACES)
    multimers = spark.createDataFrame([("c", "m1", ["A", "B", "M", "P", "U"])], "case string, multimer_id string, member_chain_ids array<string>")
    units = {tuple(r.tcr_chain_ids): (r.tcr_type, r.warnings) for r in complexes.tcr_units(chains, faces).collect()}
    assert units == {("A", "B"): ("alpha_beta", []), ("G",): ("gamma", ["unpaired_tcr_chain"])}
    second = {tuple(r.mhc_chain_ids): (r.mhc_class, r.auxiliary_chain_ids) for r in complexes.pmhc_units(chains, faces, multimers).collect()}
    assert second == {("M",): ("I", ["U"]), ("N", "O"): ("II", [])}
    got = complexes.tcr_complexes(chains, faces, multimers).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.tcr_chain_ids, r.mhc_chain_ids, r.peptide_chain_ids, r.auxiliary_chain_ids, r.num_tcr_pmhc_interfaces, r.contact_score) == (["A", "B"], ["M"], ["P"], ["U"], 2, 550.0)
    assert (r.supporting_multimer_ids, r.warnings) == (["m1"], [])


def hit(code, start, end, score, species="human"):
    return {"id": f"{species}_{code}", "code": code, "start": start, "end": end, "score": float(score), "species": species}


def test_immune_chains(spark):
    kinds = "array<struct<id:string,code:string,start:int,end:int,score:double,species:string>>"
    schema = f"path string, label_asym_id string, description string, sequence string, hits {kinds}, numbering array<struct<code:string,start:int,labels:array<string>>>"
    long = "A" * 300
    rows = [
        ("p", "S", "scFv", long, [hit("H", 0, 120, 150), hit("K", 135, 240, 120), hit("L", 137, 240, 110)], None),
        ("p", "V", "nanobody", "A" * 125, [hit("H", 0, 120, 100, "alpaca")], None),
        ("p", "C", "some binder", "A" * 125, [hit("H", 0, 120, 100, "llama")], None),
        ("p", "F", "Fab heavy chain", "A" * 125, [hit("H", 0, 120, 100, "llama")], None),
        ("p", "L", "lambda light chain", "A" * 220, [hit("K", 0, 107, 130), hit("L", 0, 107, 110)], None),
        ("p", "T", "receptor", "A" * 220, [hit("B", 0, 112, 90)], None),
        ("p", "N", "x", "A" * 220, [hit("B", 0, 112, 70)], None),
    ]
    got = {r.label_asym_id: r for r in immune.annotate(spark.createDataFrame(rows, schema)).collect()}
    assert {k: (r.type, r.subtype, r.confidence) for k, r in got.items()} == {
        "S": (HEAVY, "scFv", "high"), "V": (HEAVY, "VHH", "medium"), "C": (HEAVY, "VHH", "medium"), "F": (HEAVY, "heavy", "medium"), "L": (LIGHT, "light:lambda", "medium"), "T": ("TCR chain", "beta", "medium"), "N": (None, None, None),
    }
    assert [u.unit_type for u in got["S"].units] == ["scFv"] and got["S"].units[0].linker == "A" * 15
    assert immune.extended_end("H", 110, 117, "A" * 112 + "VTVS" + "A" * 50) == (116, "VTVS")
    assert immune.extended_end("H", 110, 110, "A" * 112 + "VTVS" + "A" * 50) == (110, "")
    labels = [str(n) for n in range(1, 118)]
    loops = immune.regions(labels, 1)
    assert [(r["name"], r["start"], r["length"]) for r in loops] == [("cdr1", 27, 12), ("cdr2", 56, 10), ("cdr3", 105, 13)]
    assert immune.region_warnings(loops[:2]) == ["missing_cdr3"]


def test_antigen_domains(spark):
    """Domains are communities of one chain's residues; only large ones that touch the antibody stay."""
    from helixframe.operators import domains

    rng = np.random.default_rng(8)
    rows = []
    for k, centre in enumerate(((0, 0, 0), (40, 0, 0))):
        rows += [("c", "X", "antigen", 100 * k + i, *(np.array(centre) + rng.normal(size=3) * 2).tolist()) for i in range(15)]
    rows += [("c", "X", "antigen", 500, 200.0, 0.0, 0.0)]
    rows += [("c", "H", "antibody", i, *(np.array((0, 5, 0)) + rng.normal(size=3)).tolist()) for i in range(1, 131)]
    residues = spark.createDataFrame(rows, "complex string, chain string, role string, res_id int, x double, y double, z double")
    kept = spark.createDataFrame([("c", "H", [(1, 100)])], "complex string, chain string, domains array<struct<fv_start:int,fv_end:int>>")
    own = domains.antibody_residues(residues, kept)
    assert own.count() == 100
    none = spark.createDataFrame([], kept.schema)
    assert domains.antibody_residues(residues, none).count() == 120
    found = domains.antigen_domains(residues.where("role = 'antigen'"), domains.contacts(own, residues.where("role = 'antigen'"))).collect()
    stay = {int(r.residue.split("|")[1]) for r in found if r.kept}
    assert stay and stay <= set(range(15)) and {r.size for r in found if r.residue == "X|500"} == {1}
    spans = {(r.chain, r.role): [tuple(x) for x in r.intervals] for r in domains.refined_chains(residues, kept).collect()}
    assert spans["H", "antibody"] == [(1, 100)] and all(b < 15 for _, b in spans["X", "antigen"])
    far = domains.refined_chains(residues.where("role = 'antibody' or res_id > 90"), kept).where("role = 'antigen'").first()
    assert far.warning == "no antibody-antigen residue contacts; kept full antigen" and len(far.intervals) == 2


def test_kept_domains(spark):
    from helixframe.operators import domains

    kinds = "array<struct<number:int,code:string,warnings:array<string>,end_motif:string>>"
    rows = [(1, [(0, "H", ["sadie_missing_fr4_region"], "VTVS"), (1, "K", [], "")], [("ab_unit_01", "scFv", ["vd_01_H", "vd_02_K"])], "scFv", HEAVY),
            (2, [(0, "K", [], ""), (1, "H", [], "")], [], "paired_heavy_light", HEAVY), (3, [(0, "H", [], ""), (1, "K", [], "")], [("ab_unit_01", "single_light_variable_domain", ["vd_02_K"])], "", LIGHT)]
    df = spark.createDataFrame(rows, f"k int, domains {kinds}, units array<struct<unit_id:string,unit_type:string,domain_ids:array<string>>>, unit string, type string")
    got = df.select("k", domains.kept_domains(F.col("domains"), F.col("units"), F.col("unit"), F.col("type")).alias("d")).withColumn("w", domains.boundary_warnings(F.col("d"))).collect()
    assert {r.k: [d.code for d in r.d] for r in got} == {1: ["H", "K"], 2: ["H"], 3: ["K"]}
    assert {r.k: r.w for r in got}[1] == ["fv_boundary_repaired_by_motif_requires_review", "sadie_missing_fr4_region"]


def test_cases_are_dealt_once(spark):
    """Complexes of the tables: rows go by case once, and what a unit touches by unit once."""
    from helixframe.plans import structural

    plan = lambda rows: rows._jdf.queryExecution().optimizedPlan().toString()
    chains, faces = structural._faces(spark, "/root/testdata/sf0.001")
    assert "Window" not in plan(faces) and "Join" not in plan(faces) and "Aggregate" not in plan(chains)
    out = structural.antibody_antigen_complexes(spark, "/root/testdata/sf0.001")
    assert plan(out).count("Relation") <= 2


def test_tasks_hold_rows_by_number(spark, monkeypatch):
    """Pairs and references are dealt to more tasks where there are more rows, with the same result."""
    from itertools import combinations

    from helixframe.engine import cluster
    from helixframe.operators import relational, tables

    monkeypatch.setattr(tables, "DEALT_ROWS", 50)
    own = [(k % 40, k * k % 23 if k % 9 else None) for k in range(400)] + [(None, 1), (None, 2)]
    got = relational.cooccurrences(spark.createDataFrame(own, "g long, m long"), "g", "m")
    want: dict = {}
    for g in range(40):
        for pair in combinations(sorted({m for x, m in own if x == g and m is not None}), 2):
            want[pair] = want.get(pair, 0) + 1
    assert {(r.a, r.b): r.shared for r in got.collect()} == want
    # More than the four partitions of the session's shuffles.
    parts = lambda rows: rows.rdd.getNumPartitions()
    assert parts(got) > 4

    text = "pdb_id string, assembly_id string, "
    table = lambda columns, rows: spark.createDataFrame(rows, text + ", ".join(f"{c} string" for c in columns.split()))
    prep = {
        "dimers": table("label_asym_id_1 label_asym_id_2", [(f"e{k % 30}", str(1 + k % 2), f"c{k % 7}", f"c{k % 5}") for k in range(300)]), "multimers": table("member_chain_ids", [("e1", "2", '["x","y",null,""]')]),
        "antibody_complexes": table("antibody_chain_ids antigen_chain_ids", [("e2", "2", None, '["z"]')]),
        "tcr_complexes": table("tcr_chain_ids mhc_chain_ids peptide_chain_ids auxiliary_chain_ids", [("e3", "2", '["t"]', '["m"]', "[]", None)]),
    }
    refs = cluster.high_order_references(prep)
    want_refs = {(f"e{k % 30}", str(1 + k % 2), f"c{k % n}") for k in range(300) for n in (7, 5)} | {("e1", "2", "x"), ("e1", "2", "y"), ("e2", "2", "z"), ("e3", "2", "t"), ("e3", "2", "m")}
    assert sorted(map(tuple, refs.collect())) == sorted(want_refs) and parts(refs) > 4
