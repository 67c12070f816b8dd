"""Identity clusters against a greedy loop over all pairs."""

import numpy as np
import pytest

from helixframe.operators import identity

LETTERS = list("ACDEFGHIKLMNPQRSTVWY")


def family(rng, base, share):
    """A sequence with some letters replaced, and maybe some cut or put in."""
    out = [rng.choice(LETTERS) if rng.random() < share else x for x in base]
    at = int(rng.integers(0, len(out)))
    return "".join(out[:at] + (out[at + 3 :] if rng.random() < 0.5 else [*rng.choice(LETTERS, 2), *out[at:]]))


def greedy(rows, least_identity, least_cover):
    """Each sequence in order joins the first representative that accepts it, among all."""
    leaders, out = [], {}
    for name, s in sorted(rows, key=lambda r: (-len(r[1]), r[0])):
        hit = next((n for n, t in leaders if identity.accepts(t, s, least_identity, least_cover)), None)
        if hit is None:
            leaders.append((name, s))
        out[name] = hit or name
    return out


@pytest.mark.parametrize(("most", "levels", "shares"), [(64, identity.LEVELS, (0.0, 0.05, 0.1, 0.2)), (3, (5, 8), (0.0, 0.02, 0.03, 0.04))])
def test_clusters_equal_a_greedy_loop(spark, most, levels, shares):
    """Families with a common tag, near copies, short pieces and equal sequences; a small limit sends words through all levels and rounds of centres."""
    rng = np.random.default_rng(3)
    tag, rows = "MGSSHHHHHHSSGLVPRGSH", []
    for k in range(8):
        base = list(rng.choice(LETTERS, 50 + 6 * k))
        for j in range(9):
            s = family(rng, base, shares[j % 4])
            rows.append((f"m{k}{j}", (tag if j % 3 == 0 and k < 5 else "") + s if j < 7 else s[: len(s) // 2]))
    rows += [("z1", rows[0][1]), ("z0", rows[0][1]), ("short", "MGS"), ("short2", "MGS")]
    got = identity.identity_clusters(spark.createDataFrame([*rows, ("none", None), ("empty", "")], "m string, s string"), "m", "s", levels=levels, most=most).collect()
    want = greedy(rows, 0.4, 0.8)
    assert {r.m: r.representative for r in got} == want and len(got) == len(rows)
    assert 8 < len(set(want.values())) < len(rows) / 2
    assert all(r["size"] == sum(x == r.representative for x in want.values()) for r in got)


def test_frequent_words_make_few_pairs(spark):
    """A tag that all sequences hold makes no pairs of its own; what stands beside it makes few."""
    rng = np.random.default_rng(5)
    rows = [(f"m{k:03d}", "MGSSHHHHHHSSGLVPRGSH" + "".join(rng.choice(LETTERS, 60)), 80) for k in range(200)]
    own = spark.createDataFrame(rows, "m string, s string, n int")
    kept, hot = identity.words(own, most=20)
    assert identity.candidates(kept, 0.8).count() < 200 * 20 / 2 and hot.count() == 0
