"""Immune chains by sequence: variable domains from profile hits, units, and the class of a chain.

The profile search itself is outside (it needs trained profiles): hits come as
a table, one row a chain, with ``hits`` as an array of structs (code, start,
end, score, species; half-open from 0) and, where numbered, ``numbering`` as an
array of structs (code, start, labels), a label for each residue from ``start``.
A chain is a row, so nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions import fixed as X
from helixframe.functions.scalars import first_motif, letters_only

# Ends of the J region by chain code, and limits.
END_MOTIFS = {
    "H": ("VTVS", "VTVT", "VTVW", "VTVA", "VTVM", "VTVP", "VTVL", "VSSP", "VSSS", "VSSA", "VSSM", "MVTW", "MVTV"),
    "K": ("VEIK", "LEIK", "VDIK", "LDIK", "TEIK", "VEIN", "LEIN"),
    "L": ("VTVL", "LTVL", "VTVF", "LTVF", "VTVS", "LTVS"),
}
EXTEND_BACK, EXTEND_AHEAD, FULL_CDR3 = 5, 40, 115
LINKER_LENGTHS = (5, 80)
SHARE, PREFERRED_WITHIN = 0.4, 25.0
VHH_LENGTHS = (95, 160)


def code_type(code: Column) -> Column:
    """(type, subtype) of a chain code."""
    out = lambda t, s: F.struct(F.lit(t).alias("type"), F.lit(s).alias("subtype"))
    found = F.when(code == "H", out(X.ANTIBODY_TYPES[0], "heavy"))
    for c, s in (("K", "light:kappa"), ("L", "light:lambda")):
        found = found.when(code == c, out(X.ANTIBODY_TYPES[1], s))
    for c, s in (("A", "alpha"), ("B", "beta"), ("G", "gamma"), ("D", "delta")):
        found = found.when(code == c, out(X.TCR, s))
    return found


def suggests_vhh(description: Column) -> Column:
    """A description that names a nanobody, or a usual short name of one."""
    d = F.lower(F.coalesce(description, F.lit("")))
    return d.rlike("nanobody|nanobdoy|vhh") | d.rlike(r"\bnb[_-]?[a-z0-9]+\b") | d.rlike(r"\bla[a-z]{1,3}\d+\b")


def preferred_codes(description: Column) -> Column:
    """Chain codes that a description hints at."""
    d = F.lower(F.coalesce(description, F.lit("")))
    return F.filter(F.array(*[F.when(d.contains(word), F.lit(code)) for code, word in X.CHAIN_CODES.items()]), lambda x: x.isNotNull())


def overlap(a: dict, b: dict) -> int:
    return max(0, min(a["end"], b["end"]) - max(a["start"], b["start"]))


def select_domains(hits: list[dict], preferred: list[str], limit: int = X.DOMAIN_LIMIT) -> list[dict]:
    """One hit for each group of hits that overlap by a share of the shorter one, in order of the sequence.

    Hits come best first and join the first group with such a member; a group's
    best gives way to one of a preferred code that is nearly as good.
    """
    groups: list[list[dict]] = []
    for hit in sorted(hits, key=lambda h: (-h["score"], h["start"], h["id"])):
        size = hit["end"] - hit["start"]
        home = next((g for g in groups if any(0 < (s := min(size, x["end"] - x["start"])) and overlap(hit, x) >= SHARE * s for x in g)), None)
        if home is None:
            groups.append([hit])
        else:
            home.append(hit)
    chosen = []
    for group in groups[:limit]:
        ranked = sorted(group, key=lambda h: (-h["score"], h["code"]))
        liked = (h for h in ranked if h["code"] in preferred and ranked[0]["score"] - h["score"] <= PREFERRED_WITHIN)
        chosen.append(next(liked, ranked[0]))
    return sorted(chosen, key=lambda h: (h["start"], -h["score"]))


def matched(numbered: list[dict], hits: list[dict]) -> list[dict | None]:
    """For each numbered domain the hit of its code that overlaps most (then the better, then the earlier); each hit serves once."""
    left, out = list(range(len(hits))), []
    for item in numbered:
        span = {"start": item["start"], "end": item["start"] + item["length"]}
        same = [k for k in left if hits[k]["code"] == item["code"]]
        best = max(same, key=lambda k: (overlap(span, hits[k]), hits[k]["score"], -k), default=None)
        if best is not None:
            left.remove(best)
        out.append(None if best is None else hits[best])
    return out


def regions(labels: list[str], start: int) -> list[dict]:
    """Loops of a numbered domain: where labels lie in their ranges. ``start`` is the place (from 1) of the first residue."""
    number = [int("".join(c for c in x if c.isdigit()) or 0) for x in labels]
    out = []
    for name, (lo, hi) in X.CDR_RANGES.items():
        inside = [k for k, n in enumerate(number) if lo <= n <= hi]
        if inside:
            out.append({"name": name, "start": start + inside[0], "end": start + inside[-1], "length": len(inside), "first": labels[inside[0]], "last": labels[inside[-1]]})
    return out


def region_warnings(found: list[dict]) -> list[str]:
    """D5."""
    have = {r["name"] for r in found}
    out = {f"missing_{n}" for n in X.CDR_RANGES if n not in have}
    for r in found:
        out |= {f"invalid_{r['name']}_{what}" for what, ok in (("length", r["length"] > 0), ("numbering_start", r["first"][:1].isdigit()), ("numbering_end", r["last"][:1].isdigit())) if not ok}
    return sorted(out)


def extended_end(code: str, end: int, cdr3_end: int, sequence: str) -> tuple[int, str]:
    """The end of a variable domain whose third loop is whole but whose last frame is cut: that of the first end motif nearby."""
    motifs = END_MOTIFS.get(code, ())
    if not motifs or cdr3_end < FULL_CDR3 or end + 5 >= len(sequence):
        return end, ""
    for k in range(max(end - EXTEND_BACK, 0), min(end + EXTEND_AHEAD, len(sequence) - 3)):
        if sequence[k : k + 4] in motifs:
            return (k + 4, sequence[k : k + 4]) if k + 4 > end else (end, "")
    return end, ""


def units_of(domains: list[dict], sequence: str) -> tuple[list[dict], list[str]]:
    """Neighbours of heavy and light code with a linker of fit length are scFv units; others stand alone."""
    own = sorted((d for d in domains if d["code"] in "HKL"), key=lambda d: (d["fv_start"], -d["score"]))
    name = lambda d: f"vd_{d['number'] + 1:02d}_{d['code']}"
    used, units, rejected = set(), [], 0
    for a, b in zip(own, own[1:], strict=False):
        if name(a) in used or name(b) in used or ((a["code"] == "H") == (b["code"] == "H")):
            continue
        gap = max(0, b["fv_start"] - a["fv_end"] - 1)
        if not LINKER_LENGTHS[0] <= gap <= LINKER_LENGTHS[1]:
            rejected += 1
            continue
        used |= {name(a), name(b)}
        units.append({"unit_type": "scFv", "domain_ids": [name(a), name(b)], "orientation": f"{a['code']}-{b['code']}", "linker": sequence[a["fv_end"] : b["fv_start"] - 1]})
    scfv = len(units)
    for d in own:
        if name(d) not in used:
            kind = "single_heavy_variable_domain" if d["code"] == "H" else "single_light_variable_domain"
            units.append({"unit_type": kind, "domain_ids": [name(d)], "orientation": d["code"], "linker": ""})
    for k, u in enumerate(units):
        u["unit_id"] = f"ab_unit_{k + 1:02d}"
    said = [("heavy_light_domains_without_valid_scfv_linker_length", rejected), ("multiple_scfv_units_on_single_chain", scfv > 1), ("multiple_antibody_units_on_single_chain", len(units) > 1)]
    return units, [text for text, yes in said if yes]


DOMAIN = "struct<number:int,code:string,start:int,end:int,fv_start:int,fv_end:int,score:double,species:string,end_motif:string,cdrs:array<struct<name:string,start:int,end:int,length:int,first:string,last:string>>,warnings:array<string>>"
UNIT = "struct<unit_id:string,unit_type:string,domain_ids:array<string>,orientation:string,linker:string>"


def _domains(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for sequence, preferred, hits, numbering in zip(pdf["letters"], pdf["preferred"], pdf["hits"], pdf["numbering"], strict=True):
            hits = [dict(h) for h in (hits if hits is not None else []) if h["score"] >= X.DOMAIN_BITSCORE]
            chosen = select_domains(hits, list(preferred))
            numbered = [dict(n) | {"length": len(n["labels"])} for n in (numbering if numbering is not None else [])]
            numbered = numbered or [{"code": h["code"], "start": h["start"], "length": h["end"] - h["start"], "labels": []} for h in chosen]
            domains, said = [], []
            for k, (item, hit) in enumerate(zip(numbered, matched(numbered, chosen), strict=True)):
                start, end = item["start"] + 1, item["start"] + item["length"]
                loops = regions(list(item["labels"]), start)
                cdr3 = next((int("".join(c for c in r["last"] if c.isdigit()) or 0) for r in loops if r["name"] == "cdr3"), 0)
                last, motif = extended_end(item["code"], end, cdr3, sequence)
                warned = (region_warnings(loops) if len(item["labels"]) else []) + (["sadie_missing_fr4_region", "fv_boundary_extended_by_fr4_motif"] if motif else [])
                said += [w for w in warned if w not in said]
                domains.append({"number": k, "code": item["code"], "start": start, "end": end, "fv_start": start, "fv_end": last, "score": hit["score"] if hit else 0.0, "species": hit["species"] if hit else None, "end_motif": motif, "cdrs": loops, "warnings": warned})
            units, more = units_of(domains, sequence)
            out.append((domains, units, said + [w for w in more if w not in said]))
        found = pd.DataFrame(out, columns=["domains", "units", "warnings"], index=pdf.index)
        yield pd.concat([pdf[["path", "label_asym_id", "description", "letters"]], found], axis=1)


def annotate(chains: DataFrame) -> DataFrame:
    """Type, subtype, unit, confidence and warnings of each chain by its domains.

    ``chains`` has path, label_asym_id, description, sequence, hits, numbering.
    """
    rows = chains.select("path", "label_asym_id", "description", letters_only(F.coalesce("sequence", F.lit(""))).alias("letters"), preferred_codes(F.col("description")).alias("preferred"), "hits", "numbering")
    kinds = dict(rows.dtypes)
    found = rows.mapInPandas(_domains, f"path {kinds['path']}, label_asym_id string, description string, letters string, domains array<{DOMAIN}>, units array<{UNIT}>, warnings array<string>")
    has = lambda codes: F.exists("domains", lambda d: d["code"].isin(*codes))
    heavy, light = has(("H",)), has(("K", "L"))
    scfv = F.exists("units", lambda u: u["unit_type"] == "scFv")
    d = F.lower(F.coalesce("description", F.lit("")))
    camel = F.exists("domains", lambda x: F.lower(F.coalesce(x["species"], F.lit(""))).isin(*X.CAMELIDS))
    alone = (F.size("domains") == 1) & heavy & camel & F.length("letters").between(*VHH_LENGTHS)
    vhh = suggests_vhh(F.col("description")) | ((d != "") & alone & ~d.rlike("heavy chain|light chain|fab"))
    light_code = F.filter("domains", lambda x: x["code"].isin("K", "L"))[0]["code"]
    first = code_type(F.col("domains")[0]["code"])
    kind = lambda t, s, u=None: F.struct(F.lit(t).alias("type"), (s if isinstance(s, Column) else F.lit(s)).alias("subtype"), F.lit(u).cast("string").alias("unit_type"))
    decided = (
        F.when(F.size("domains") == 0, None)
        .when(scfv, kind(X.ANTIBODY_TYPES[0], "scFv", "scFv")).when(heavy & light, kind(X.ANTIBODY_TYPES[0], "heavy"))
        .when(heavy & vhh, kind(X.ANTIBODY_TYPES[0], "VHH", "VHH")).when(heavy, kind(X.ANTIBODY_TYPES[0], "heavy"))
        .when(light, kind(X.ANTIBODY_TYPES[1], code_type(light_code)["subtype"])).when(first["type"] == X.TCR, kind(X.TCR, first["subtype"]))
    )
    top = F.array_max(F.transform("domains", lambda x: x["score"]))
    label = F.when(top >= 140, "high").when(top >= X.DOMAIN_BITSCORE, "medium").otherwise("low")
    score = F.when(label == "high", 0.95).when(label == "medium", 0.85).otherwise(0.7)
    out = found.withColumn("_k", decided)
    none = F.col("_k.type").isNull()
    return out.select(
        "path", "label_asym_id", F.col("_k.type").alias("type"), F.col("_k.subtype").alias("subtype"), F.col("_k.unit_type").alias("unit_type"),
        F.when(~none, label).alias("confidence"), F.when(~none, score).alias("score"), F.coalesce(top, F.lit(0.0)).alias("top_bitscore"),
        first_motif(F.col("letters"), X.LINKER_MOTIFS).alias("linker_motif"), "domains", "units", "warnings",
        F.filter(F.array(F.when(d.rlike("|".join(X.ANTIBODY_WORDS)), "antibody_context"), F.when(d.rlike("|".join(X.TCR_WORDS)), "tcr_context")), lambda x: x.isNotNull()).alias("description_hits"),
    )


def antibody_view(found: DataFrame) -> DataFrame:
    """D3: antibody chains with a heavy and a light score."""
    heavy = (F.col("type") == X.ANTIBODY_TYPES[0]) | (F.col("unit_type") == "scFv")
    lightish = (F.col("type") == X.ANTIBODY_TYPES[1]) | (F.col("unit_type") == "scFv")
    score = lambda yes: F.round(F.when(F.coalesce(yes, F.lit(False)), F.col("top_bitscore")).otherwise(0.0), 3)
    return found.where(F.col("type").isin(*X.ANTIBODY_TYPES)).withColumns({"heavy_score": score(heavy), "light_score": score(lightish)})


def cropped(residues: Column, fv_start: Column, fv_end: Column) -> Column:
    """Residues (structs with res_id) of the variable domain; the first 120 where there is none."""
    inside = F.filter(residues, lambda x: (x["res_id"] >= fv_start) & (x["res_id"] <= fv_end))
    return F.when(fv_start.isNull() | fv_end.isNull(), F.slice(residues, 1, 120)).otherwise(inside)
