"""Case documents to tables, in each layout."""

import gzip
import json

import pytest

from helixframe.sources import bundles

CHAIN = {"label_asym_id": "A", "entity_id": "1", "polymer_type": "polypeptide(L)", "chain_type": "other protein chain", "sequence": "g s", "length": 2}
LIGAND = {"label_asym_id": "L", "entity_id": "2", "chain_type": "small molecule compound", "sequence": "ATP"}
OTHER = {"label_asym_id": "X", "chain_type": "other polymer chain", "polymer_type": "other", "special_residue_details": [{"label_seq_id": 1, "monomer_id": "ABC"}]}
FACE = {"assembly_id": "1", "label_asym_id_1": "A", "label_asym_id_2": "B", "buried_area": 500.5, "sym_id_1": 0}


def case(pdb_id, **more):
    summary = {"pdb_id": pdb_id, "source_path": f"/x/{pdb_id}.cif", "entry_metadata": {"experimental_method": "X-RAY DIFFRACTION", "resolution": "2.1"}}
    return {"structure_summary": summary, "chain_inventory": [CHAIN, CHAIN | {"label_asym_id": "B"}, LIGAND, OTHER], "dimer_interfaces": [], "tight_multimers": []} | more


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    raw = json.dumps(value).encode()
    path.write_bytes(gzip.compress(raw) if path.suffix == ".gz" else raw)


@pytest.fixture
def source(tmp_path):
    root = tmp_path / "in"
    put(root / "1abc" / "result.json.gz", case("1abc", dimer_interfaces=[FACE, FACE]))
    # A bundle of the case hides those of assemblies beside it.
    put(root / "1abc" / "result_assembly_9.json.gz", case("9zzz"))
    put(root / "2abc" / "result_assembly_2.json.gz", case("2abc"))
    put(root / "2abc" / "result_assembly_10.json.gz", case("2abc"))
    put(root / "3abc" / "assembly_1" / "result.json.gz", case("3abc"))
    for name, value in case("4abc").items():
        put(root / "4abc" / "final" / f"{name}.json", value)
    # Inside another case nothing is a case.
    put(root / "1abc" / "deep" / "result.json", case("8zzz"))
    (root / "bad").mkdir()
    (root / "bad" / "result.json").write_text("{nothing")
    return str(root)


def test_layouts(spark, source):
    cases = bundles.scan(spark, source)
    got = sorted((r.case_dir.rsplit("/", 1)[1], r.structure_summary.pdb_id, r.assembly) for r in cases.where("structure_summary is not null").collect())
    assert got == [("1abc", "1abc", "1"), ("2abc", "2abc", "10"), ("2abc", "2abc", "2"), ("3abc", "3abc", "1"), ("4abc", "4abc", "")]
    assert bundles.corrupt(cases).count() == 1
    assert [(r.source_path, r.assembly_ids) for r in bundles.source_map(cases).where("source_path like '%2abc%'").collect()] == [("/x/2abc.cif", ["2", "10"])]
    with pytest.raises(Exception, match="more than one bundle"):
        bundles.single(cases).collect()


def test_prep_tables(spark, source, tmp_path):
    counts = bundles.build_prep(spark, source, str(tmp_path / "out"))
    read = lambda name: bundles.prep_table(spark, str(tmp_path / "out"), name)
    assert counts["monomers"] == 15 and counts["dimers"] == 2 and counts["corrupt"] == 1
    assert {(r.method_priority, r.resolution) for r in read("entry_quality").collect()} == {(0, 2.1)}
    one = read("monomers").where("pdb_id = '1abc'").collect()
    assert sorted((r.monomer_id, r.polymer_class, r.sequence) for r in one) == [("1abc:1:A", "protein", "GS"), ("1abc:1:B", "protein", "GS"), ("1abc:1:X", "other_polymer", "")]
    assert sorted(r.monomer_id for r in read("monomers").where("pdb_id = '4abc'").collect()) == ["4abc:A", "4abc:B", "4abc:X"]
    assert sorted(r.observation_id for r in read("dimers").collect()) == ["1abc:1:1", "1abc:1:2"]
    assert read("multimers").count() == 0 and "multimer_type" in read("multimers").columns
    bundles.merge(spark, [str(tmp_path / "out" / "dimers")] * 2, str(tmp_path / "merged"))
    assert spark.read.parquet(str(tmp_path / "merged")).count() == 4
