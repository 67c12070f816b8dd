"""Whole runs on small inputs, and the tables, memos, lists and reports around them."""

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_structures import FILE

from helixframe.engine import cluster, parse
from helixframe.engine.settings import ClusterSettings, ParseSettings, changed, from_toml, strict_cutoff
from helixframe.operators import identity, memo, refinement, reports, scheduling
from helixframe.sources import bundles, inputs, sinks


def test_settings():
    a, b = from_toml("[settings]\nmodel = 2\n[clustering]\ncutoff_date = 2021-09-30", {"settings": {"model": 3}})
    assert (a.model, b.cutoff_date) == (3, "2021-09-30")
    for bad in ("[settings]\nmodel = 0", "[settings]\nnothing = 1", "[other]\nx = 1", "[clustering]\ncutoff_date = '2021-9-30'", "[settings]\ninclude_asym = true", "[clustering]\ntm_score_threshold = 1.5"):
        with pytest.raises(ValueError):
            from_toml(bad)
    assert changed(ParseSettings().fingerprint(), ParseSettings(model=2, verbose=True).fingerprint()) == ["model"]
    assert strict_cutoff(None) == "" and strict_cutoff(" 2020-02-29 ") == "2020-02-29"


def test_inputs(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for name in ("b.cif", "a.cif.gz", "deep/1abc-assembly1.cif", "note.txt"):
        (tmp_path / name).write_text("x")
    (tmp_path / "list.txt").write_text("# no\n\n  /q/1abc.cif \n/q/1abc.cif\n/z/1abc.cif\n/q/readme.md\n")
    found = inputs.expanded(spark, str(tmp_path)).orderBy("place").collect()
    assert [r.path.rsplit("/", 1)[1] for r in found] == ["b.cif", "1abc-assembly1.cif", "a.cif.gz"]
    named = inputs.resolved(inputs.input_list(spark, str(tmp_path / "list.txt")))
    assert sorted((r.case_id, r.input_path) for r in inputs.case_specs(named, "/out").collect()) == [("1abc_01", "/q/1abc.cif"), ("1abc_02", "/z/1abc.cif")]
    tree = spark.createDataFrame([("/t/5YWO.cif",), ("/t/yw/5ywo.cif.gz",), ("/t/5ywo.bcif",), ("/t/1xyz.cif",)], "path string")
    assert {r.entry: r.path for r in inputs.first_in_tree(tree).collect()} == {"5YWO": "/t/5ywo.bcif", "1XYZ": "/t/1xyz.cif"}
    specs = spark.createDataFrame([("5ywo-assembly1", "/i/5YWO-assembly1.cif"), ("9zzz", "/i/9zzz.cif")], "case_id string, input_path string")
    assert sorted(tuple(r) for r in inputs.whole_entries(specs, tree).collect()) == [("5ywo-assembly0", "/t/5ywo.bcif", None), ("9zzz-assembly0", None, "missing_metadata_cif_for_include_asym")]


def test_metadata_precedence(spark, tmp_path):
    (tmp_path / "m.csv").write_text("PDB_ID,experimental_method,resolution,release_date\n1abc,OLD,9,\n1ABC,NMR,2.345,2020-01-01\n2abc,,,\n")
    table = inputs.metadata_table(spark, str(tmp_path / "m.csv"))
    own = spark.createDataFrame([("/i/1abc-assembly1.cif", "", None, ""), ("/i/3abc.cif", "X-RAY", 1.5, "2019-01-01"), ("/i/4abc.cif", "X-RAY", None, "2019-01-01"), ("/i/5abc.cif", "", None, "")],
                                "path string, experimental_method string, resolution double, release_date string")
    tree = spark.createDataFrame([("4ABC", "EM", 3.0, "2018-01-01"), ("5ABC", "", None, "2018-01-01")], "entry string, experimental_method string, resolution double, release_date string")
    got = {r.entry: (r.experimental_method, r.resolution, r.metadata_source, r.metadata_warning) for r in inputs.enriched(own, table, tree).collect()}
    assert got == {
        "1ABC": ("NMR", 2.35, "metadata_table", ""), "3ABC": ("X-RAY", 1.5, "input_cif", ""), "4ABC": ("EM", 3.0, "full_mmcif", ""),
        "5ABC": ("", None, "input_cif", "no_entry_metadata_found_for_input_assembly; missing_resolution_in_entry_metadata"),
    } or got["1ABC"][1] == 2.34


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("protein", "b", "A" * 85), ("protein", "a", "A" * 80), ("other_polymer", "c", "X"), ("dna", "d", "AC")], "polymer_class string, monomer_id string, sequence string")
    assert {r.monomer_id: r.record for r in sinks.fasta_records(rows).collect()} == {"a": ">a\n" + "A" * 80, "b": ">b\n" + "A" * 80 + "\n" + "A" * 5, "d": ">d\nAC"}
    sinks.fasta(rows, str(tmp_path / "fasta"))
    assert sorted(p.name for p in (tmp_path / "fasta").iterdir() if p.is_dir()) == ["polymer_class=dna", "polymer_class=protein"]
    atoms = spark.createDataFrame([("s", 1, 5, 7, "A", "LONGER", "CA", "C", 1.0, 2.0, 3.0), ("s", 0, 9, 1, "", "GLY", "N", "N", -1.5, 0.0, 0.25)],
                                  "structure string, part int, atom_idx int, res_id int, ins_code string, res_name string, atom_name string, element string, x float, y float, z float")
    lines = sinks.pdb_documents(sinks.pdb_atoms(atoms)).first().document.split("\n")
    assert lines[0] == "ATOM      1  N   GLY A   1      -1.500   0.000   0.250  1.00  0.00           N" and lines[1] == "TER"
    assert lines[2] == "ATOM      2  CA  UNK B   7A      1.000   2.000   3.000  1.00  0.00           C" and lines[3:] == ["TER", "END", ""]
    page = sinks.html_report("a & b", {"t<": spark.createDataFrame([("<x>", 1.5)], "k string, v double")})
    assert "a &amp; b" in page and "&lt;x&gt;" in page and "t&lt; (1)" in page


def test_memo(spark, tmp_path):
    path = str(tmp_path / "memo")
    tasks = memo.keyed(spark.createDataFrame([("AA", "BB", "q1", "t1", 5), ("AA", "BB", "q1", "t1", 5), ("AA", "CC", "q1", "t2", 9)], "seq_query string, seq_target string, query_id string, target_id string, cost int")
                       .withColumns({c: F.lit("") for c in ("source_query", "source_target", "query_fingerprint", "target_fingerprint", "mode")}).withColumn("model", F.lit(1)).withColumn("keep_h", F.lit(False)))
    assert all(len(r.cache_key) == 32 for r in tasks.collect()) and tasks.select("cache_key").distinct().count() == 2
    memo.ask(tasks, memo.connect(spark, path), path)
    assert [r.cost for r in memo.pending_by_cost(tasks, memo.connect(spark, path), "cost").collect()] == [9, 5]
    key = tasks.where("cost = 9").first().cache_key
    done = spark.createDataFrame([(key, (10, 1.0, 0.9, 0.8, 1.0), None)], f"cache_key string, result struct<{', '.join(x.replace(' ', ':') for x in memo.RESULT.split(', '))}>, error string")
    memo.answer(done, path)
    read = memo.connect(spark, path)
    assert {r.state: r.n for r in memo.status_counts(read).collect()} == {"done": 1, "pending": 1}
    assert [r.cost for r in memo.open_tasks(tasks, read).collect()] == [5]
    memo.copied(spark, path, str(tmp_path / "other"))
    assert memo.known(tasks, memo.connect(spark, str(tmp_path / "other"))).where("result is not null").first().cost == 9


def test_scheduling(spark):
    assert scheduling.bin_packing([(5, "a"), (4, "b"), (3, "c"), (3, "d")], 2) == {"a": 0, "b": 1, "d": 1, "c": 0}
    files = spark.createDataFrame([("/x/5ywo-assembly1.cif", 10), ("/x/5ywo-assembly2.cif", 10), ("/x/a.cif", 15), ("/x/b.cif", 1)], "path string, bytes long")
    plan = {r.path: r.shard for r in scheduling.shard_plan(files, 2).collect()}
    assert plan["/x/5ywo-assembly1.cif"] == plan["/x/5ywo-assembly2.cif"] == 0 and plan["/x/a.cif"] == plan["/x/b.cif"] == 1
    assert scheduling.seeded_sample(files, 2).count() == 2
    groups = spark.range(10).withColumn("n", F.lit(3))
    assert scheduling.batches(groups, "n", "id", 9, 2).select("batch").distinct().count() >= 4


def test_alignment_and_identity():
    rng = np.random.default_rng(2)
    a = np.cumsum(rng.normal(size=(60, 3)), 0) * 2
    turn, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    turn *= np.sign(np.linalg.det(turn))
    found = refinement.align(a, a[5:55] @ turn + 9)
    assert found["aligned_length"] == 50 and found["rmsd"] < 1e-3 and found["tm_score_target"] > 0.99 and found["coverage"] == 1.0
    assert refinement.accepts(found) and refinement.align(a[:2], a)["aligned_length"] == 0
    other = refinement.align(a, np.cumsum(rng.normal(size=(60, 3)), 0) * 2)
    assert max(other["tm_score_query"], other["tm_score_target"]) < 0.6
    assert refinement.sequence_identity("ACDEFGH", "ACDEFGH") == 1.0 and refinement.sequence_identity("", "A") == 0.0
    assert refinement.sequence_identity("ACDEFGHIKL", "ACDEFGHIKV") == 0.9
    # A gap of two letters: all letters of the shorter one are matched.
    assert refinement.sequence_identity("ACDEFGHIKLMNPQ", "ACDEFGHIKLMNPQ"[:6] + "ACDEFGHIKLMNPQ"[8:]) == 1.0


def test_identity_clusters(spark):
    base = "MKTAYIAKQRQISFVKSHFSRQLEERLGLIEVQ"
    rows = [("a", base), ("b", base[:-1] + "A"), ("c", base[:10]), ("d", "WWWWWHHHHHPPPPPGGGGGDDDDD"), ("e", ""), ("f", base)]
    out = identity.identity_clusters(spark.createDataFrame(rows, "monomer_id string, sequence string"), "monomer_id", "sequence").collect()
    assert {r.monomer_id: (r.representative, r.size) for r in out} == {"a": ("a", 3), "b": ("a", 3), "f": ("a", 3), "c": ("c", 1), "d": ("d", 1)}
    assert {r.cluster_id for r in out} == {"prot_1", "prot_2", "prot_3"}


def case(spark, tmp_path):
    root = tmp_path / "cif"
    root.mkdir()
    (root / "1abc.cif.gz").write_bytes(gzip.compress(FILE.encode()))
    rng = np.random.default_rng(1)
    head = FILE[: FILE.index("ATOM 1 N")].replace("1ABC", "2DEF")
    atoms, n = [], 0
    for chain in "AB":
        for residue in range(1, 31):
            for name in ("N", "CA", "C"):
                n += 1
                x, y, z = rng.normal(size=3) * 4 + (0 if chain == "A" else 3)
                atoms.append(f"ATOM {n} {name[0]} {name} . ALA {chain} 1 {residue} {residue} {chain} {x:.3f} {y:.3f} {z:.3f} 1")
    (root / "2def.cif").write_text(head + "\n".join(atoms) + "\n")
    return str(root)


def test_parse_run(spark, tmp_path):
    source, target = case(spark, tmp_path), str(tmp_path / "out")
    settings = ParseSettings(min_polymer_chain_length=1, tight_multimer_min_buried_area=1.0)
    out = parse.run(spark, source, target, settings)
    results = {r.case_id: r for r in out["results"].collect()}
    assert {k: (r.status, r.pdb_id, r.num_chains) for k, r in results.items()} == {"1abc": ("ok", "1abc", 4), "2def": ("ok", "2def", 4)}
    assert results["2def"].num_dimers == 1 and results["2def"].num_multimers == 1 and results["2def"].resolution == 2.46
    face = out["interfaces"].first()
    assert (face.interface_label, face.is_same_entity) == ("same-entity:TCR chain", True) and face.buried_area > 0
    assert out["multimers"].first().multimer_type == "homodimer"
    assert out["summary"].first().success_count == 2 and parse.rebuilt(spark, target).first().total_dimers == 1
    again = parse.run(spark, source, target, settings, resume=True)
    assert again["results"].count() == 2
    with pytest.raises(ValueError, match="other settings"):
        parse.run(spark, source, target, ParseSettings(min_polymer_chain_length=2), resume=True)
    skipped = parse.run(spark, source, str(tmp_path / "none"), ParseSettings())["results"].collect()
    assert {(r.status, r.warning_code) for r in skipped} == {("skipped", "no_polymer_chain_above_min_length")}
    both = parse.merged_shards(spark, [target, target], str(tmp_path / "both"))
    assert both["results"].count() == 2 and both["interfaces"].count() == out["interfaces"].count()


def test_parse_assembly(spark, tmp_path):
    out = parse.run(spark, case(spark, tmp_path), str(tmp_path / "out"), ParseSettings(assembly_mode="largest_assembly", min_polymer_chain_length=1))
    assert {r.instance_1 for r in out["interfaces"].collect()} <= {"A@1", "A@2", "B@1", "B@2"} and out["interfaces"].count() >= 1


def test_cluster_run(spark, tmp_path):
    from test_bundles import CHAIN, FACE, case as bundle, put

    root = tmp_path / "in"
    other = CHAIN | {"label_asym_id": "C", "entity_id": "9", "sequence": "WWWW"}
    mult = {"assembly_id": "1", "member_chain_ids": ["A", "B"], "member_chain_types": ["x", "y"], "member_copy_numbers": [1, 1], "multimer_type": "homodimer", "support_score": 5.0}
    for k, name in enumerate(("1abc", "2abc", "3abc")):
        faces = [FACE | {"label_asym_id_2": "C"}] if k == 2 else [FACE]
        put(root / name / "result.json.gz", bundle(name, chain_inventory=[CHAIN, CHAIN | {"label_asym_id": "B"}, other], dimer_interfaces=faces, tight_multimers=[mult]))
    bundles.build_prep(spark, str(root), str(tmp_path / "prep"))
    rng = np.random.default_rng(0)
    trace = np.cumsum(rng.normal(size=(20, 3)), 0).ravel().tolist()
    far = (np.cumsum(rng.normal(size=(20, 3)), 0) * 3).ravel().tolist()
    shapes = {"dimers": spark.createDataFrame([("1abc:1:1", [trace]), ("2abc:1:1", [far])], "observation_id string, parts array<array<double>>")}
    traces = spark.createDataFrame([(f"{e}:1:{c}", trace) for e in ("1abc", "2abc", "3abc") for c in "ABC"], "monomer_id string, trace array<double>")
    out = cluster.run(spark, str(tmp_path / "prep"), str(tmp_path / "out"), ClusterSettings(protein_sequence_mode="exact"), traces, shapes)
    seq = {r.member_monomer_id: r.cluster_id for r in out["sequence_clusters"].collect()}
    assert seq["1abc:1:A"] == seq["3abc:1:B"] == "prot_2" and seq["1abc:1:C"] == "prot_1"
    made = {r.member_monomer_id: (r.structure_cluster_id, r.assignment_reason) for r in out["structure_clusters"].collect()}
    assert made["1abc:1:A"] == ("prot_2_1", "representative") and made["2abc:1:B"] == ("prot_2_1", "identical_sequence")
    dimers = {r.observation_id: (r.signature_cluster_id, r.cluster_id) for r in out["dimers"].collect()}
    assert dimers == {"1abc:1:1": ("dimsig_1", "dim_1_1"), "2abc:1:1": ("dimsig_1", "dim_1_2"), "3abc:1:1": ("dimsig_2", "dim_2_1")}
    key = out["dimers"].where("observation_id = '3abc:1:1'").first().signature_key
    assert key == '{"contains_antibody_unit":false,"contains_tcr_pmhc_unit":false,"interface_label":"","is_same_entity":false,"members":[{"chain_type":"","monomer_cluster_id":"prot_1_1"},{"chain_type":"","monomer_cluster_id":"prot_2_1"}]}'
    assert out["multimers_warnings"].count() == 3 and out["multimers"].count() == 0


def test_observations_need_clusters(spark):
    rows = spark.createDataFrame([("o", "p", "1", "A", "x", "B", "y")], "observation_id string, pdb_id string, assembly_id string, label_asym_id_1 string, chain_type_1 string, label_asym_id_2 string, chain_type_2 string")
    rows = rows.withColumns({c: F.lit(None).cast("boolean") for c in ("is_same_entity", "contains_antibody_unit", "contains_tcr_pmhc_unit")}).withColumn("interface_label", F.lit("l"))
    known = refinement.assignments(spark.createDataFrame([("p:1:A", "prot_1")], "member_monomer_id string, cluster_id string"))
    with pytest.raises(Exception, match="no cluster for p:1:B"):
        refinement.dimer_observations(rows, known).collect()


def test_complex_observations(spark):
    known = refinement.assignments(spark.createDataFrame([(f"p:1:{c}", f"prot_{k}") for k, c in enumerate("HLXAB", 1)], "member_monomer_id string, cluster_id string"))
    own = spark.createDataFrame([("p:1:B", "peptide antigen")], "monomer_id string, chain_type string")
    one = spark.createDataFrame([("o", "p", "1", "paired_heavy_light", "H", "L", '["H","L"]', '["X"]', '["other protein chain"]', '["Z"]', '["G"]')],
                                "observation_id string, pdb_id string, assembly_id string, antibody_unit_type string, antibody_heavy_chain string, antibody_light_chain string, antibody_chain_ids string, antigen_chain_ids string, antigen_chain_types string, auxiliary_component_ids string, auxiliary_branched_ids string")
    key = refinement.antibody_observations(one, known, own).first().signature_key
    assert key == '{"antibody_members":[{"monomer_cluster_id":"prot_1","role":"heavy"},{"monomer_cluster_id":"prot_2","role":"light"}],"antibody_unit_type":"paired_heavy_light","antigen_members":[{"chain_type":"other protein chain","monomer_cluster_id":"prot_3"}],"auxiliary_components":[{"chain_type":"auxiliary_nonpolymer","monomer_cluster_id":"auxiliary_nonpolymer"}],"heavy_cluster_id":"prot_1","light_cluster_id":"prot_2","num_auxiliary_branched":1}'
    two = spark.createDataFrame([("o", "p", "1", "alpha_beta", "I", '["H","L"]', '["X"]', '["class_i_heavy"]', '["B"]', '["A"]')],
                                "observation_id string, pdb_id string, assembly_id string, tcr_type string, mhc_class string, tcr_chain_ids string, mhc_chain_ids string, mhc_chain_roles string, peptide_chain_ids string, auxiliary_chain_ids string")
    key = refinement.tcr_observations(two, known, own).first().signature_key
    assert '"peptide_members":[{"chain_type":"peptide antigen","monomer_cluster_id":"prot_5"}]' in key and '"tcr_members":[{"monomer_cluster_id":"prot_1","role":"alpha"},{"monomer_cluster_id":"prot_2","role":"beta"}]' in key


def test_reports(spark, tmp_path):
    from test_bundles import CHAIN, case as bundle, put

    heavy = CHAIN | {"chain_type": "antibody heavy chain", "subtype": "heavy", "annotation_confidence": 0.7, "warnings": ["w1", "w1"]}
    root = tmp_path / "in"
    put(root / "a" / "result.json.gz", bundle("aaaa", chain_inventory=[heavy, CHAIN | {"chain_type": "TCR chain", "label_asym_id": "T"}, CHAIN | {"chain_type": "MHC heavy chain", "label_asym_id": "M"}],
                                              tcr_pmhc_complexes=[{"peptide_chain_ids": ["A"], "warnings": ["unpaired_tcr_chain"]}]))
    put(root / "b" / "result_assembly_1.json.gz", bundle("bbbb", chain_inventory=[heavy, heavy | {"label_asym_id": "B", "paired_label_asym_id": "L"}]))
    put(root / "b" / "result_assembly_2.json.gz", bundle("bbbb", chain_inventory=[heavy, heavy | {"label_asym_id": "B", "paired_label_asym_id": "L"}]))
    cases = bundles.scan(spark, str(root))
    short = F.regexp_extract("case_dir", "([^/]+)$", 1)
    metrics = reports.case_metrics(cases).withColumn("case_dir", short).cache()
    got = {r.case_dir: r for r in metrics.collect()}
    assert (got["a"].num_unpaired_antibody_heavy_chains, got["b"].num_unpaired_antibody_heavy_chains, got["b"].num_low_confidence_antibody_chains, got["b"].num_processed_assemblies) == (1, 1, 2, 2)
    evidence = lambda told, **more: heavy | more | {"features": {"antibody_analysis": {"heavy_only_evidence": {"is_true_heavy_only": told}}}}
    fused = heavy | {"features": {"antibody_unit_type": "scFv"}}
    other = tmp_path / "other"
    put(other / "c" / "result.json.gz", bundle("cccc", chain_inventory=[evidence(False), evidence(True, paired_label_asym_id="L"), heavy, fused, CHAIN]))
    told = reports.case_metrics(bundles.scan(spark, str(other))).first()
    assert (told.num_true_heavy_only_chains, told.num_unpaired_antibody_heavy_chains) == (2, 2)
    warnings = reports.warnings_of(cases).withColumn("case_dir", short)
    counts = {(r.case_dir, r.kind, r.code): r.n for r in warnings.collect()}
    assert counts["a", "chain", "w1"] == 2 and counts["b", "chain", "w1"] == 4 and counts["a", "parse", "unpaired_tcr_chain"] == 1
    assert [(r.case_dir, r.n) for r in reports.top_cases(metrics, "case_dir", "num_low_confidence_antibody_chains").collect()] == [("b", 2), ("a", 1)]
    lists = {(r.list, r.case_dir): r.rank for r in reports.metric_lists(metrics).collect()}
    assert lists["antibody_low_confidence", "b"] == 1 and lists["antibody_low_confidence", "a"] == 2
    assert [(r.list, r.case_dir) for r in reports.warning_lists(warnings).collect()] == [("tcr_unpaired_chain_warning", "a")]
    assert reports.unmatched_receptors(metrics).collect() == []
    results = spark.createDataFrame([("x", "/x", "ok", None, 3, 1), ("y", "/y", "skipped", "too_many; other", 0, 0), ("z", "/z", "ok", None, 4, 0)], "case_id string, input_path string, status string, warning_code string, num_chains int, num_dimers int")
    results = results.withColumns({c: F.lit(0) for c in ("num_multimers", "num_antibody_antigen_complexes", "num_tcr_pmhc_complexes")}).withColumn("num_assemblies_processed", F.lit(None).cast("int"))
    s = reports.batch_summary(results).first()
    assert (s.total_cases, s.success_count, s.total_chains, s.total_processed_assemblies, s.average_chains_per_successful_case, s.average_dimers_per_successful_case) == (3, 2, 7, 2, 3.5, 0.5)
    assert {r.code for r in reports.skip_codes(results).collect()} == {"too_many", "other"}


def test_stored_atoms(spark, tmp_path):
    from helixframe.sources import atoms

    rows = [("s", a, c, k, i, "C", "CA", float(i), 0.0, 0.0) for i, (a, c, k) in enumerate([("1", "A", 0), ("1", "A", 1), ("1", "B", 0), ("2", "A", 0)])] + [("t", None, "A", 0, 9, "H", "H", float("nan"), 0.0, 0.0)]
    raw = spark.createDataFrame(rows, "source_path string, assembly_id string, chain_id string, sym_id int, atom_idx int, element string, atom_name string, x double, y double, z double")
    atoms.store(raw, str(tmp_path / "atoms"))
    kept = atoms.load(spark, str(tmp_path / "atoms"))
    want = spark.createDataFrame([("p", "s", "1", "A", 1, 1), ("p", "s", "1", "B", None, 2), ("q", "s", "1", "A", None, 1), ("q", "s", "1", "Z", None, 2), ("r", "t", "7", "A", None, 1)],
                                 "structure string, source_path string, assembly_id string, chain_id string, sym_id int, part int")
    found = atoms.chains(kept, want)
    assert sorted((r.structure, r.chain_id, r.sym_id, r.atom_idx) for r in found.collect()) == [("p", "A", 1, 1), ("p", "B", 0, 2), ("r", "A", 0, 9)]
    assert [r.structure for r in atoms.missing(want, found).collect()] == ["q"] and [r.structure for r in atoms.oversized(found, 1).collect()] == ["p"]
    assert {r.source_path: (r.hydrogen_atoms_removed, r.nonfinite_atoms_removed, r.kept) for r in atoms.removed_counts(raw, ["source_path"]).collect()} == {"s": (0, 0, 4), "t": (1, 1, 0)}
    (tmp_path / "inv.json").write_text('{"monomer_id":"a","n":1}\n{"monomer_id":"a","n":2}\n{"monomer_id":"","n":3}\n')
    assert [(r.monomer_id, r.n) for r in atoms.inventory_rows(spark, str(tmp_path / "inv.json")).collect()] == [("a", 2)]


def test_remembered_alignments(spark, tmp_path):
    from helixframe.operators import alignments

    rng = np.random.default_rng(4)
    a = np.cumsum(rng.normal(size=(20, 3)), 0).ravel().tolist()
    tasks = spark.createDataFrame([("k1", a, a), ("k2", a, a[:6]), ("k3", a, None)], "cache_key string, trace_query array<double>, trace_target array<double>")
    first = {r.cache_key: (r.state, r.result) for r in alignments.remembered(tasks, str(tmp_path / "memo")).collect()}
    assert first["k1"][0] == "done" and first["k1"][1].tm_score_query == 1.0 and first["k2"][0] == first["k3"][0] == "failed"
    assert memo.open_tasks(tasks, memo.connect(spark, str(tmp_path / "memo"))).count() == 2
    shown = alignments.scored(alignments.aligned(tasks.where("cache_key = 'k1'"))).first()
    assert shown.meets_tm_threshold and shown.meets_coverage_threshold and shown.error is None


def test_command_line(spark, tmp_path, capsys):
    from helixframe.engine.__main__ import main

    source = case(spark, tmp_path)
    (tmp_path / "c.toml").write_text("[settings]\nmin_polymer_chain_length = 1\n")
    assert main(["--config", str(tmp_path / "c.toml"), "--set", "settings.tight_multimer_min_buried_area=1.0", "parse", source, str(tmp_path / "out")], spark) == 0
    assert main(["report", str(tmp_path / "out")], spark) == 0 and "'success_count': 2" in capsys.readouterr().out
    assert main(["prep", str(tmp_path / "out"), str(tmp_path / "prep")], spark) == 0 and "'dimers': 1" in capsys.readouterr().out
    greedy = ["--set", "clustering.protein_sequence_mode=exact", "cluster", str(tmp_path / "prep"), str(tmp_path / "clusters")]
    with pytest.raises(ValueError, match="stored atoms"):
        main(greedy, spark)
    assert main([*greedy, "--run", str(tmp_path / "out")], spark) == 0
    made = spark.read.option("header", "true").csv(str(tmp_path / "clusters" / "structure_clusters")).collect()
    assert {r.member_monomer_id for r in made} == {"1abc:A", "1abc:B", "2def:A", "2def:B"} and "representative" in {r.assignment_reason for r in made}
    assert [r.cluster_id for r in spark.read.parquet(str(tmp_path / "clusters" / "dimers")).collect()] == ["dim_1_1"]
    documents = [p for p in (tmp_path / "out" / "documents").rglob("*.gz")]
    assert len(documents) == 2 and all('"chain_inventory":[{' in gzip.decompress(p.read_bytes()).decode() for p in documents)
    assert main(["shards", source, str(tmp_path / "shards"), "--count", "2"], spark) == 0
    assert sorted(p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()) == ["shard=0", "shard=1"]


def test_structures_of_observations(spark):
    """Chains of each kind of observation, all or none, with a common copy, and the residues near the other side."""
    from helixframe.engine import structures

    rows, n = [], 0
    for chain, sym, x in (("A", 0, 0.0), ("A", 1, 100.0), ("B", 1, 105.0), ("C", 0, 6.0)):
        for residue in range(1, 5):
            n += 1
            rows.append(("s", "1", chain, sym, n, residue, "", "GLY", "CA", "C", x + 20.0 * (residue - 1), 0.0, 0.0))
    atoms = spark.createDataFrame(rows, "source_path string, assembly_id string, chain_id string, sym_id int, atom_idx int, res_id int, ins_code string, res_name string, atom_name string, element string, x double, y double, z double")
    pick = lambda stage, obs: {(r.structure, r.chain_id, r.sym_id, r.res_id) for r in structures.extracted(stage, obs, atoms).collect()}
    base = "observation_id string, source_path string, assembly_id string"
    dimers = spark.createDataFrame([("d1", "s", "1", "A", 1, "B", 1), ("d2", "s", "1", "A", 0, "Z", 0)], f"{base}, label_asym_id_1 string, sym_id_1 int, label_asym_id_2 string, sym_id_2 int")
    assert pick("dimers", dimers) == {("d1", c, 1, r) for c in "AB" for r in range(1, 5)}
    antibody = spark.createDataFrame([("a", "s", "1", '["A","A"]', '["B"]')], f"{base}, antibody_chain_ids string, antigen_chain_ids string")
    assert {x[:3] for x in pick("antibody_complexes", antibody)} == {("a", "A", 1), ("a", "B", 1)}
    multimers = spark.createDataFrame([("m", "s", "1", '["A"]', '[{"instance_id":"A@2","label_asym_id":"A"},{"label_asym_id":"C","sym_id":0}]'), ("p", "s", "1", '["C","A"]', None)], f"{base}, member_chain_ids string, member_instances string")
    assert {x[:3] for x in pick("multimers", multimers)} == {("m", "A", 1), ("m", "C", 0), ("p", "A", 0), ("p", "C", 0)}
    tcr = spark.createDataFrame([("t", "s", "1", '["A"]', '["C"]', None, "[]")], f"{base}, tcr_chain_ids string, mhc_chain_ids string, peptide_chain_ids string, auxiliary_chain_ids string")
    found = structures.extracted("tcr_complexes", tcr, atoms)
    assert {x[:3] for x in pick("tcr_complexes", tcr)} == {("t", "A", 0), ("t", "C", 0)}
    shape = structures.traces(found).first()
    assert shape.observation_id == "t" and shape.parts[0][:3] == [0.0, 0.0, 0.0] and [len(p) for p in shape.parts] == [12, 12]
    assert structures.files(found).first().document.count("TER") == 2
    faces = spark.createDataFrame([("c", "A", "C", 3, 20, 50.0, 2.5), ("c", "C", "B", 1, 5, 10.0, 1.5), ("c", "A", "B", 9, 9, 9.0, 9.0)], "case string, label_asym_id_1 string, label_asym_id_2 string, num_residue_contacts int, num_atom_contacts int, buried_area double, min_distance double")
    parts = spark.createDataFrame([("x", "c", "A", 1), ("x", "c", "B", 1), ("x", "c", "C", 2)], "structure string, case string, chain_id string, side int")
    assert [tuple(r) for r in structures.set_metrics(faces, parts).collect()] == [("x", 4, 25, 60.0, 1.5)]


def test_refine_run(spark, tmp_path):
    from helixframe.engine import refine

    rng = np.random.default_rng(3)
    rows = [("s", None, "H", 0, i, i, "", "ALA", "CA", "C", float(i), 0.0, 0.0) for i in range(1, 131)]
    rows += [("s", None, "X", 0, 1000 + i, i, "", "ALA", "CA", "C", *(np.array((60, 4, 0)) + rng.normal(size=3)).tolist()) for i in range(1, 16)]
    schema = "source_path string, assembly_id string, chain_id string, sym_id int, atom_idx int, res_id int, ins_code string, res_name string, atom_name string, element string, x double, y double, z double"
    atoms = spark.createDataFrame(rows, schema).withColumn("assembly_id", F.lit("au"))
    complexes = spark.createDataFrame([("o", "s", "", '["H"]', '["X"]', "VHH")], "observation_id string, source_path string, assembly_id string, antibody_chain_ids string, antigen_chain_ids string, antibody_unit_type string")
    kinds = "domains array<struct<number:int,code:string,fv_start:int,fv_end:int>>, units array<struct<unit_id:string,unit_type:string,domain_ids:array<string>>>"
    annotated = spark.createDataFrame([("s", "H", 2, "x", [], []), ("s", "H", 1, "antibody heavy chain", [(0, "H", 1, 110)], [])], f"source_path string, chain_id string, place int, chain_type string, {kinds}")
    out = {(r.chain, r.role): ([tuple(x) for x in r.intervals], r.warning) for r in refine.run(complexes, atoms, annotated, str(tmp_path / "files")).collect()}
    assert out["H", "antibody"] == ([(1, 110)], None) and out["X", "antigen"][1] is None
    text = spark.read.json(str(tmp_path / "files")).first().document
    assert text.count("ATOM") == 110 + sum(b - a + 1 for a, b in out["X", "antigen"][0])


def test_suites_and_datasets(spark, tmp_path):
    from helixframe.engine import suites

    source = case(spark, tmp_path)
    settings = ParseSettings(min_polymer_chain_length=1, output_format="csv")
    totals = {r.metric: r.total for r in suites.smoke(spark, source, str(tmp_path / "smoke"), 1, settings).collect()}
    assert totals["num_chains"] == 4.0 and (tmp_path / "smoke" / "csv" / "chains").exists()
    (tmp_path / "list.txt").write_text(f"# two\n{source}/2def.cif\n{source}/2def.cif\n")
    out = suites.representative(spark, str(tmp_path / "list.txt"), str(tmp_path / "suite"), settings, ("asymmetric_unit", "first_assembly"))
    assert {k: v.first().total_cases for k, v in out.items()} == {"asymmetric_unit": 1, "first_assembly": 1}
    own = spark.createDataFrame([("a",), ("b",), ("c",)], "monomer_id string")
    pairs = spark.createDataFrame([("b", "b"), ("b", "c"), ("a", "a")], "representative string, member string")
    assert {r.monomer_id: (r.cluster_id, r.size) for r in cluster.from_pairs(pairs, own).collect()} == {"a": ("prot_1", 1), "b": ("prot_2", 2), "c": ("prot_2", 2)}
    with pytest.raises(Exception, match="no monomer for z"):
        cluster.from_pairs(spark.createDataFrame([("a", "z")], pairs.schema), own).collect()
    target = str(tmp_path / "made")
    spark.createDataFrame([("cutoff_date", "2020-01-01"), ("protein_structure_mode", "greedy"), ("structure_clusters", "false")], "name string, value string").write.json(f"{target}/settings")
    own.write.json(f"{target}/monomer_inventory")
    own.write.csv(f"{target}/sequence_clusters")
    assert cluster.dataset(spark, target, ClusterSettings(cutoff_date="2020-01-01"))["monomer_inventory"].count() == 3
    with pytest.raises(ValueError, match="cutoff"):
        cluster.dataset(spark, target, ClusterSettings())
    with pytest.raises(ValueError, match="no structure clusters"):
        cluster.dataset(spark, target, ClusterSettings(cutoff_date="2020-01-01"), structures=True)
