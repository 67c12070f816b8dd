"""Operators of the structural engine on small fixtures, and registered queries against SQL."""

import itertools

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.functions import chains
from helixframe.functions import scalars as S
from helixframe.operators import geometry, graphs, multimers
from helixframe.plans import catalogue, files, rules, runs  # noqa: F401
from helixframe.sources import mmcif

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", [n for n in rules.QUERIES if n in catalogue.ORACLE_SQL])
def test_query(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got, want = catalogue.QUERIES[name](spark, SF).toPandas(), db.execute(catalogue.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    rows = lambda f: sorted(map(repr, f[columns].astype(object).where(f[columns].notna(), None).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def value(spark, column, *rows, schema="v string"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], schema).select(column).collect()]


def test_text_rules(spark):
    v = F.col("v")
    assert value(spark, S.null_text(v), " a ", "?", ".", "", None) == ["a", None, None, None, None]
    assert value(spark, S.case_id(v), "X/1ABC.bcif.gz", "/a/b.cif", "c.txt") == ["1abc", "b", "c.txt"]
    assert value(spark, S.entry_from_name(v), "5ywo-assembly1.cif.gz", "long_name.cif") == ["5ywo", None]
    assert value(spark, S.assembly_from_name(v), "5YWO-assembly2.cif.gz", "5ywo.cif") == ["2", None]
    assert value(spark, S.operations(v), None, "1-3,5", "(1,2)(3-4)") == [["1"], ["1", "2", "3", "5"], ["1x3", "1x4", "2x3", "2x4"]]
    assert value(spark, chains.mhc_class(v), "HLA class II histocompatibility", "HLA-A heavy chain", "HLA-DRA chain", "MHC") == ["II", "I", "II", "unknown"]
    assert value(spark, S.confidence(F.col("v"), F.lit(100)), 140, 100, 79, schema="v int") == ["high", "medium", "low"]
    assert value(spark, S.date_decision(v, F.lit("2021-09-30").cast("date")), "2021-09-29", "2021-09-30", "2021-9-1", "", None) == ["kept", "too_recent", "invalid", "missing", "missing"]


def test_chain_classes(spark):
    rows = [
        ("polymer", "polypeptide(L)", "Beta-2-microglobulin", None, False, "beta2m or auxiliary immune chain", "beta2m", 0.8),
        ("polymer", "polypeptide(L)", "HLA-A heavy chain", None, False, "MHC heavy chain", "class_i", 0.8),
        ("polymer", "polypeptide(L)", "T cell receptor beta chain", None, False, "TCR chain", "beta", 0.8),
        ("polymer", "polypeptide(L)", "lysozyme", None, False, "other protein chain", "protein", 0.95),
        ("polymer", "polypeptide(L)", "Fab", "antibody heavy chain", False, "antibody heavy chain", "heavy", 0.95),
        ("polymer", "polydeoxyribonucleotide", None, None, False, "DNA chain", "DNA", 0.95),
        ("polymer", "polydeoxyribonucleotide/polyribonucleotide hybrid", None, None, False, "other nucleic acid chain", "dna/rna hybrid", 0.95),
        ("branched", None, None, None, False, "glycan / branched component", "glycan", 0.95),
        ("non-polymer", None, None, None, True, "metal ion", "ion", 0.95),
        ("non-polymer", None, None, None, False, "small molecule compound", "ligand", 0.9),
        ("water", None, None, None, False, "other entity", "water", 0.9),
        (None, None, None, None, False, "other entity", None, 0.4),
    ]
    df = spark.createDataFrame([r[:5] for r in rows], "e string, p string, d string, immune string, metal boolean")
    subtype = F.when(F.col("immune").isNotNull(), "heavy")
    got = df.select(chains.chain_class(F.col("e"), F.col("p"), F.col("d"), F.col("immune"), subtype, F.lit(0.7), F.col("metal")).alias("c")).select("c.*")
    assert [tuple(r) for r in got.collect()] == [r[5:] for r in rows]
    v = F.col("v")
    assert value(spark, chains.mhc_role(v), "class II alpha chain", "HLA-DRB1", "HLA-B", "x") == ["class_ii_alpha", "class_ii_beta", "class_i_heavy", "unknown"]
    parts = spark.createDataFrame([("ZN", "ZINC ION", "Zn 2+"), ("FE", "FERRIC", "Fe"), ("GOL", "GLYCEROL", "C3 H8 O3"), ("HOH", "ION WATER", "H2 O")], "id string, name string, formula string")
    assert [r[0] for r in parts.select(chains.is_metal(F.col("id"), F.col("name"), F.col("formula"))).collect()] == [True, True, False, False]


def test_multimers(spark):
    rows = [("c", f"A@{i}", f"A@{j}", "A", "A", 900.0, 30) for i, j in itertools.combinations(range(1, 4), 2)] + [("c", "A@1", "B@1", "A", "B", 100.0, 5)]
    df = spark.createDataFrame(rows, "case string, instance_1 string, instance_2 string, entity_1 string, entity_2 string, buried_area double, num_atom_contacts int")
    out = multimers.tight_multimers(df, least_area=500).collect()
    assert [(r.num_member_instances, r.num_internal_edges, r.multimer_type, r.support_score) for r in out] == [(3, 3, "homomultimer", 30.0)]


CIF = """data_1ABC
_entry.id 1ABC # comment
_struct.title 'a title with it's quote'
_struct.text
;first line
 second 'line'
;
loop_
_atom_site.group_PDB
_atom_site.type_symbol
_atom_site.label_atom_id
_atom_site.label_alt_id
_atom_site.label_comp_id
_atom_site.label_asym_id
_atom_site.label_seq_id
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
_atom_site.occupancy
ATOM C CA . GLY A 1 1.0 2.0 3.0 1.0
ATOM C CA A SER A 2 4.0 2.0 3.0 0.4
ATOM C CA B SER A 2 5.0 2.0 3.0 0.6
ATOM H H . GLY A 1 1.0 2.0 3.5 1.0
ATOM N N . GLY A 3 ? 2.0 3.5 1.0
loop_
_pdbx_struct_assembly_gen.assembly_id
_pdbx_struct_assembly_gen.asym_id_list
_pdbx_struct_assembly_gen.oper_expression
1 A 1,2
loop_
_pdbx_struct_oper_list.id
_pdbx_struct_oper_list.matrix[1][1]
_pdbx_struct_oper_list.matrix[1][2]
_pdbx_struct_oper_list.matrix[1][3]
_pdbx_struct_oper_list.vector[1]
_pdbx_struct_oper_list.matrix[2][1]
_pdbx_struct_oper_list.matrix[2][2]
_pdbx_struct_oper_list.matrix[2][3]
_pdbx_struct_oper_list.vector[2]
_pdbx_struct_oper_list.matrix[3][1]
_pdbx_struct_oper_list.matrix[3][2]
_pdbx_struct_oper_list.matrix[3][3]
_pdbx_struct_oper_list.vector[3]
1 1 0 0 0 0 1 0 0 0 0 1 0
2 -1 0 0 10 0 -1 0 0 0 0 1 0
"""


def test_structure_files(spark, tmp_path):
    import gzip

    (tmp_path / "sub").mkdir()
    (tmp_path / "1abc.cif").write_text(CIF)
    (tmp_path / "sub" / "2abc.cif.gz").write_bytes(gzip.compress(CIF.encode()))
    found = mmcif.scan(spark, str(tmp_path)).cache()
    assert {(r.value) for r in mmcif.first_value(found, "entry", "id").collect()} == {"1ABC"}
    struct = mmcif.category(found, "struct", ["title", "text", "none"]).collect()
    assert {(r.title, r.text, r.none) for r in struct} == {("a title with it's quote", "first line\n second 'line'", None)}
    assert {r.rows for r in mmcif.row_counts(found, "atom_site", "Cartn_x").collect()} == {5}
    places = sorted((r.res_id, r.x) for r in mmcif.atoms(found).where("path like '%1abc%'").collect())
    assert places == [(1, 1.0), (2, 5.0)]
    moved = mmcif.assembly_atoms(found, "1").where("path like '%2abc%'").collect()
    assert sorted((r.sym_id, r.res_id, r.x, r.y) for r in moved) == [(0, 1, 1.0, 2.0), (0, 2, 5.0, 2.0), (1, 1, 9.0, -2.0), (1, 2, 5.0, -2.0)]


def test_contacts(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-10, 10, (80, 3)).astype(np.float32)
    rows = [("c", i, "AB"[i % 2], *map(float, p)) for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, "case string, id int, owner string, x float, y float, z float")
    a, b = df.where("owner = 'A'"), df.where("owner = 'B'")
    found = geometry.contacts(a, b, "case", 4.5)
    want = {(i, j) for i in range(0, 80, 2) for j in range(1, 80, 2) if np.sqrt(((x[i] - x[j]) ** 2).sum()) <= 4.5}
    assert {(r.id, r.id_2) for r in found.collect()} == want
    m = geometry.interface_metrics(found, "case").collect()[0]
    assert (m.pairs, m.left, m.right) == (len(want), len({i for i, _ in want}), len({j for _, j in want}))
    near = {r.id: r.distance for r in geometry.nearest_owner(found, "case").collect()}
    assert set(near) == {i for i, _ in want}


def test_superposition_and_area():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(40, 3)) * 8
    q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    assert geometry.tm_score(a, a @ q + 5, 40) > 0.999
    one = geometry.accessible_area(np.zeros((1, 3)), np.array([1.7]))
    assert abs(one[0] - 4 * np.pi * 3.1**2) < 1e-9
    two = geometry.accessible_area(np.array([[0, 0, 0], [1.5, 0, 0.0]]), np.array([1.7, 1.7]))
    assert (two < one[0]).all()


def test_bridges_and_communities():
    clique = lambda nodes: {tuple(sorted(e)): 1.0 for e in itertools.combinations(nodes, 2)}
    weights = clique(range(6)) | clique(range(10, 16)) | {(5, 10): 0.5}
    adjacent = {}
    for u, v in weights:
        adjacent.setdefault(u, set()).add(v)
        adjacent.setdefault(v, set()).add(u)
    assert graphs.bridges_of(adjacent) == {(5, 10)}
    assert (5, 10) not in graphs.pruned(weights, 2, 8)
    assert (5, 10) in graphs.pruned(weights, 2, 50)
    found = graphs.communities_of(weights)
    assert {found[x] for x in range(6)} == {0} and {found[x] for x in range(10, 16)} == {10}


def test_communities_stay_in_components(spark):
    edges = catalogue._edges(spark, SF)
    label = {(r.case, r.node): r.component for r in graphs.case_components(edges, "case").collect()}
    groups = {}
    for r in graphs.communities(edges, "case").collect():
        groups.setdefault((r.case, r.community), set()).add(label[r.case, r.node])
    assert groups and all(len(x) == 1 for x in groups.values())


def test_greedy_matching(spark):
    rows = [(1, "H1", "L1", 900), (1, "H1", "L2", 950), (1, "H2", "L2", 940)]
    df = spark.createDataFrame(rows, "case int, h string, l string, area int")
    assert [tuple(r) for r in graphs.greedy_matching(df, "case", "h", "l", ["area"], [True]).collect()] == [(1, "H1", "L2")]


def test_leaders(spark):
    """Rounds give what one pass in order gives, whatever the size of a round."""
    from helixframe.operators.clustering import leader_clusters

    near = {("a", "b"), ("b", "c"), ("c", "d")}
    df = spark.createDataFrame([(1, x) for x in "abcd"], "bucket int, name string").withColumn("load", F.col("name"))
    accept = lambda one, many: np.array([[(x, y) in near for x in one] for y in many], bool).reshape(len(many), len(one))
    out = leader_clusters(df, "bucket", "name", ["name"], "load", accept, kind="string")
    assert sorted((r.leader, r.name) for r in out.collect()) == [("a", "a"), ("a", "b"), ("c", "c"), ("c", "d")]
    rng = np.random.default_rng(3)
    points = [(int(b), i, rng.normal(size=2).tolist()) for i, b in enumerate(rng.integers(0, 3, 120))]
    close = lambda one, many: np.array([[np.hypot(*np.subtract(x, y)) < 0.7 for x in one] for y in many], bool).reshape(len(many), len(one))
    want = set()
    for bucket in range(3):
        led = []
        for _, i, p in (r for r in points if r[0] == bucket):
            k = next((j for j, q in led if np.hypot(*np.subtract(p, q)) < 0.7), None)
            if k is None:
                led.append((i, p))
            want.add((bucket, i if k is None else k, i))
    df = spark.createDataFrame(points, "bucket int, id long, p array<double>")
    for size in (7, 512):
        got = leader_clusters(df, "bucket", "id", ["id"], "p", close, lead_rows=size)
        assert {tuple(r) for r in got.collect()} == want


def test_missing_lookup_fails(spark):
    from helixframe.operators.relational import looked_up

    with pytest.raises(Exception, match="no part for 2"):
        looked_up(spark.createDataFrame([(2,)], "k int"), spark.createDataFrame([(1, "a")], "k int, v string"), ["k"], "part").collect()


def test_containment_by_whole_units(spark, tmp_path):
    """Units have the members of all their rows, not of returned first lines only; against brute force."""
    from helixframe.operators.relational import contained

    rng = np.random.default_rng(4)
    lines = [(int(o), int(p), int(m), "RN"[o % 2], "F", int(k)) for k, (o, p, m) in enumerate(rng.integers(0, (12, 40, 6), (150, 3)), 1)]
    lines += [(1, 99, m, "N", "O", 7) for m in range(6)] + [(2, 98, 0, "R", "F", 1), (77, 98, 50, "N", "O", 2)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string, l_linenumber long"
    spark.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    units, sets = {}, {}
    for o, p, m, *_ in lines:
        units.setdefault(p, set()).add(m)
        sets.setdefault(o, set()).add(m)
    want = {(u, o) for u, x in units.items() for o, y in sets.items() if x <= y}
    got = [tuple(r) for r in catalogue.QUERIES["set_containment_all"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) and len(want) > 20 and (99, 1) in want and 98 not in {u for u, _ in want}
    df = lambda rows: spark.createDataFrame(rows, "u int, m int")
    odd = contained(df([(1, None), (1, 2), (2, 2), (3, 9)]), df([(None, 2), (5, 2), (5, 3)]).toDF("s", "m"), "u", "s", "m")
    assert {tuple(r) for r in odd.collect()} == {(2, None), (2, 5)}


def test_missing_members_are_clustered(spark):
    """Members that no cluster has: equal sequences together, the longest first, from the next free number."""
    from helixframe.operators.clustering import missing_clusters, next_cluster_index

    rows = spark.createDataFrame([(1, "AAAA"), (2, "CC"), (3, "BBB"), (4, "CC"), (5, "AAAA"), (6, None), (7, "ABCD"), (8, "")], "id long, s string")
    old = spark.createDataFrame([(1, "prot_2"), (9, "prot_10"), (10, "prot_x"), (11, "rna_70")], "id long, cluster_id string")
    out = missing_clusters(rows, "id", F.col("s"), old, "prot_").collect()
    assert sorted(tuple(r) for r in out) == [
        (2, "prot_14", 2, 2), (3, "prot_13", 3, 1), (4, "prot_14", 2, 2), (5, "prot_11", 5, 1), (6, "prot_15", 6, 2), (7, "prot_12", 7, 1), (8, "prot_15", 6, 2),
    ]
    assert next_cluster_index(old.where("id > 10"), "cluster_id", "prot_") == 1


def test_supporting_sets_meet_the_other_side(spark):
    """A set that holds the unit but nothing of the second set does not support it."""
    from helixframe.operators.relational import supporting

    df = lambda rows: spark.createDataFrame(rows, "u long, m string")
    sets = df([(7, "H"), (7, "L"), (7, "A"), (8, "H"), (8, "L"), (9, "H"), (9, "A"), (9, "B")]).toDF("s", "m")
    out = supporting(df([(1, "H"), (1, "L"), (2, "H")]), df([(1, "A"), (1, "B"), (2, "B"), (3, "A")]), sets, "u", "s", "m")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 7), (2, 9)]


def test_large_cases_go_by_rounds(spark):
    """Components and matchings of a case too large for a task are those of one task."""
    rng = np.random.default_rng(6)
    rows = [(int(c), int(u), int(v) + 100, int(w)) for c, u, v, w in zip(rng.integers(0, 3, 300), rng.integers(0, 40, 300), rng.integers(0, 40, 300), rng.integers(0, 9, 300), strict=True)]
    edges = spark.createDataFrame(rows, "case int, u int, v int, w int").dropDuplicates(["case", "u", "v"])
    found = lambda limit: {tuple(r) for r in graphs.case_components(edges, "case", limit).collect()}
    assert found(10) == found(10**6) == {(c, n, k) for c in range(3) for n, k in graphs.components_of({(r.u, r.v) for r in edges.collect() if r.case == c}).items()}
    paired = lambda limit: {tuple(r) for r in graphs.greedy_matching(edges, "case", "u", "v", ["w"], [True], limit).collect()}
    want = set()
    for c in range(3):
        used = set()
        for w, u, v in sorted((-r.w, r.u, r.v) for r in edges.collect() if r.case == c):
            if u not in used and v not in used:
                used |= {u, v}
                want.add((c, u, v))
    assert paired(10) == paired(10**6) == want


def test_many_small_cases_take_no_call_each(spark):
    # A call a case (as groups of pandas frames make) took 30 seconds and more for these.
    import time

    rows = spark.range(240_000).selectExpr("id div 4 as case", "concat('h', id % 2) as h", "concat('l', id div 2 % 2) as l", "cast(id * 7919 % 1000 as double) as area")
    begun = time.time()
    got = {tuple(r) for r in graphs.greedy_matching(rows, "case", "h", "l", ["area"], [True]).where("case < 50").collect()}
    assert time.time() - begun < 20
    by = {}
    for i in range(200):
        by.setdefault(i // 4, []).append((-(i * 7919 % 1000), f"h{i % 2}", f"l{i // 2 % 2}"))
    want = set()
    for case, edges in by.items():
        used = set()
        for _, h, low in sorted(edges):
            if not used & {h, low}:
                used |= {h, low}
                want.add((case, h, low))
    assert got == want


def test_communities_by_component(spark):
    # Two components of one case: together they are what one pass over the whole graph finds.
    rng = np.random.default_rng(5)
    edges = {(int(min(a, b)) + k, int(max(a, b)) + k): float(w) for k in (0, 100) for a, b, w in zip(rng.integers(0, 30, 70), rng.integers(0, 30, 70), rng.integers(1, 9, 70)) if a != b}
    df = spark.createDataFrame([(None, u, v, w) for (u, v), w in edges.items()] + [("x", u, v, w) for (u, v), w in edges.items()], "case string, u long, v long, weight double")
    found = graphs.communities_of(graphs.pruned(edges, 2, 8))
    want = {(case, x, c) for x, c in found.items() for case in (None, "x") if list(found.values()).count(c) >= 2}
    assert {tuple(r) for r in graphs.communities(df, "case").collect()} == want


def test_files_share_batches():
    # A batch a file and category (six of them here) cost more than reading did.
    import pyarrow as pa

    text = b"data_a\n_entry.id a\nloop_\n_x.a\n_x.b\n1 2\n3 4\n"
    files = pa.RecordBatch.from_arrays([pa.array(["p", "bad", "q"]), pa.array([text, text + b"5", text])], names=["path", "content"])
    (made,) = mmcif._read([files])
    rows = [(r["path"], r["category"], r["row_idx"], dict(r["cells"])) for r in made.to_pylist() if r["category"] != mmcif.FILE]
    want = lambda p: [(p, "x", 0, {"a": "1", "b": "2"}), (p, "x", 1, {"a": "3", "b": "4"}), (p, "entry", 0, {"id": "a"})]
    assert [r for r in rows if r[0] != "bad"] == want("p") + want("q")
    assert [(r["path"], r["error"] is None) for r in made.to_pylist() if r["category"] == mmcif.FILE] == [("p", True), ("bad", False), ("q", True)]


def test_chain_operations_in_order_of_rows(spark):
    from helixframe.operators import inventory

    rows = [("f", 3, "1", "B,A", "3-1"), ("f", 1, "1", "A, B", "2,5"), ("f", 2, "1", "A", "2,5"), ("f", 4, "2", "A", None), ("g", 1, "1", "A", "(1,2)(P)")]
    gen = spark.createDataFrame(rows, "path string, row_idx int, assembly_id string, asym_id_list string, oper_expression string")
    got = {(r.path, r.assembly_id, r.chain_id): (r.operations, r.copies) for r in inventory.chain_operations(gen).collect()}
    want = {("f", "1", "A"): ["2", "5", "3", "1"], ("f", "1", "B"): ["2", "5", "3", "1"], ("f", "2", "A"): ["1"], ("g", "1", "A"): ["1xP", "2xP"]}
    assert got == {k: (v, len(v)) for k, v in want.items()}
    # One chain of many generators: lists of all their operations, told apart in one row, took minutes.
    many = spark.range(20_000).selectExpr("'f' as path", "cast(id as int) as row_idx", "'1' as assembly_id", "'A' as asym_id_list", "concat('1-', 1 + id % 50, ',', id) as oper_expression")
    assert [r.copies for r in inventory.chain_operations(many).collect()] == [20_000]


@pytest.mark.parametrize("name, table", [("strict_date_parse", "orders"), ("numeric_aware_order", "part"), ("oper_expression", "part")])
def test_rows_are_a_tables(spark, name, table):
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert catalogue.QUERIES[name](spark, SF).count() == n > 100


def test_dimer_observations_are_made_once(spark):
    # What goes on are written signatures: a plan that still reads interfaces makes observations again for each use.
    from helixframe.plans import structural

    assert not any("lineitem" in f for f in structural.dimer_signatures(spark, SF).inputFiles())


def test_equal_line_items_are_interfaces_each(spark, tmp_path):
    # Observations were told apart by their id: equal line items became one, and SQL counts both.
    from helixframe.plans import structural

    for t in ("part", "supplier"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    line = spark.read.parquet(f"{SF}/lineitem.parquet").limit(300)
    line.unionByName(line.limit(100)).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {tuple(r) for r in structural.dimer_signatures(spark, str(tmp_path)).select("signature_cluster_id", "signature_cluster_size", "signature_key").collect()}
    want = duckdb.connect().execute(f"create view lineitem as select * from read_parquet('{tmp_path}/lineitem.parquet/*.parquet')").execute(catalogue.ORACLE_SQL["dimer_signatures"]).fetchall()
    assert got == set(want) and sum(r[1] for r in got) == 400


def test_rows_of_signatures_are_not_broadcast(spark):
    # Equal texts take little of a file: 300,000 rows were taken for the small side of the join and sent to the driver.
    from helixframe.operators import clustering
    from helixframe.operators.tables import written

    rows = written(spark.range(300_000).selectExpr("id as item", "repeat(cast(id % 5 as string), 500) as sig").coalesce(1))
    found = clustering.signature_groups(rows, "item", "sig", "g_")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" in plan and "BuildLeft" not in plan
    assert found.where("cluster_id is null").isEmpty() and found.count() == 300_000


def test_only_named_categories_are_kept(spark):
    # All rows of all categories were written, whatever a query reads of them; damage elsewhere in a file still counts.
    text = b"data_a\n_entry.id a\nloop_\n_x.a\n_x.b\n1 'b c'\n3 \"4\" # n\nloop_\n_y.a\n_y.b\n5 6\n"
    df = spark.createDataFrame([("p", bytearray(text)), ("bad", bytearray(text + b"7"))], "path string, content binary")
    rows = mmcif.parsed(df, "x").collect()
    assert [(r.path, r.row_idx, r.cells) for r in rows if r.category != mmcif.FILE and r.path == "p"] == [("p", 0, {"a": "1", "b": "b c"}), ("p", 1, {"a": "3", "b": "4"})]
    assert {r.category for r in rows} == {"x", mmcif.FILE}
    assert {(r.path, r.error is None) for r in rows if r.category == mmcif.FILE} == {("p", True), ("bad", False)}


def test_edges_kept_by_flat_arrays():
    # One large component took sets and tuples of all its edges: 285 bytes each.
    import tracemalloc

    rng = np.random.default_rng(3)
    for k in range(300):
        n = int(rng.integers(2, 30))
        tree = {tuple(sorted((i, int(rng.integers(0, i))))): float(rng.integers(1, 9)) for i in range(1, n)}
        more = {(int(min(a, b)), int(max(a, b))): 5.0 for a, b in rng.integers(0, n, (k % 12, 2)) if a != b}
        weights = dict(sorted((tree | more).items()))
        assert {(u, v): w for u, v, w in graphs.kept_edges(((u, v, w) for (u, v), w in weights.items()), 2, 8)} == graphs.pruned(weights, 2, 8)
    tracemalloc.start()
    count = sum(1 for _ in graphs.kept_edges(((i, 1_000_000 + j, 1.0) for i in range(300) for j in range(i, i + 300)), 2, 8))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == 89_998 and peak / count < 150
