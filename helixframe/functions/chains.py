"""Chain classes from entity, polymer and description texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers in lower-case descriptions.
CLASS_II = ("hla-dq", "hla-dr", "hla-dp", "h2-ia", "h2-ie")
CLASS_I = ("hla-a", "hla-b", "hla-c", "hla-e", "hla-f", "hla-g", "beta-2-microglobulin-free")
ALPHA = ("hla-dra", "hla-dqa1", "hla-dpa1", "dq alpha", "dr alpha", "dp alpha", "dq-alpha", "dr-alpha", "dp-alpha", "alpha 1 chain", "a-b alpha chain")
BETA = ("hla-drb", "hla-dqb1", "hla-dpb1", "dq beta", "dr beta", "dp beta", "dq-beta", "dr-beta", "dp-beta", "beta 1 chain", "a beta chain")
MICROGLOBULIN = ("beta-2-microglobulin", "beta 2 microglobulin")
MHC = ("major histocompatibility", "histocompatibility antigen", "mhc", "hla-")
RECEPTOR = ("t cell receptor", "tcr")
RECEPTOR_CHAINS = ("alpha", "beta", "gamma", "delta")


def _any(text: Column, markers: tuple[str, ...]) -> Column:
    return F.coalesce(text.rlike("|".join(m.replace(".", r"\.") for m in markers)), F.lit(False))


def _low(description: Column) -> Column:
    return F.lower(F.coalesce(description, F.lit("")))


def mhc_class(description: Column) -> Column:
    """A class that is spelled out, else that of a locus, else unknown."""
    d = _low(description)
    return (
        F.when(d.rlike(r"\bclass[\s-]*ii\b"), "II").when(d.rlike(r"\bclass[\s-]*i\b"), "I")
        .when(_any(d, CLASS_II), "II").when(_any(d, CLASS_I), "I").otherwise("unknown")
    )


def mhc_role(description: Column) -> Column:
    """The chain's part in its class."""
    d, c = _low(description), mhc_class(description)
    alpha = F.when(d.rlike(r"\balpha\b"), True).when(d.rlike(r"\bbeta\b"), False).when(_any(d, ALPHA), True).when(_any(d, BETA), False)
    second = F.when(alpha, "class_ii_alpha").when(~alpha, "class_ii_beta").otherwise("unknown")
    return F.when(c == "I", "class_i_heavy").when(c == "II", second).otherwise("unknown")


def described_type(description: Column) -> Column:
    """(type, subtype) that a description suggests; nulls where it suggests none."""
    d = _low(description)
    parts = F.lit("unknown")
    for name in reversed(RECEPTOR_CHAINS):
        parts = F.when(d.contains(name), name).otherwise(parts)
    pair = lambda a, b: F.struct(F.lit(a).alias("type"), b.cast("string").alias("subtype"))
    return (
        F.when(_any(d, MICROGLOBULIN), pair("beta2m or auxiliary immune chain", F.lit("beta2m")))
        .when(_any(d, MHC), pair("MHC heavy chain", F.concat(F.lit("class_"), F.lower(mhc_class(description)))))
        .when(_any(d, RECEPTOR), pair("TCR chain", parts))
    )


def is_metal(component: Column, name: Column, formula: Column) -> Column:
    """named an ion (water aside), or of one element without carbon."""
    tokens = F.filter(F.split(F.trim(F.coalesce(formula, F.lit(""))), r"\s+"), lambda x: x.rlike("^[A-Za-z]"))
    ion = F.upper(F.coalesce(name, F.lit(""))).contains("ION") & (F.upper(component) != "HOH")
    return component.isNotNull() & (ion | ((F.size(tokens) == 1) & ~F.upper(F.coalesce(formula, F.lit(""))).contains("C")))


def chain_class(
    entity: Column, polymer: Column, description: Column, immune_type: Column, immune_subtype: Column, immune_score: Column, all_metal: Column
) -> Column:
    """(chain_type, subtype, confidence); a sequence annotation comes before the description."""
    e, p = F.lower(F.coalesce(entity, F.lit(""))), F.lower(F.coalesce(polymer, F.lit("")))
    found = described_type(description)

    def out(kind, sub, score) -> Column:
        kind, sub, score = (x if isinstance(x, Column) else F.lit(x) for x in (kind, sub, score))
        return F.struct(kind.alias("chain_type"), sub.cast("string").alias("subtype"), score.cast("double").alias("confidence"))

    protein = (
        F.when(immune_type.isNotNull(), out(immune_type, immune_subtype, F.greatest(F.lit(0.95), immune_score)))
        .when(found.isNotNull(), out(found["type"], found["subtype"], 0.8))
        .otherwise(out("other protein chain", "protein", 0.95))
    )
    both = p.contains("polydeoxyribonucleotide") & p.contains("polyribonucleotide")
    chain = (
        F.when(p.contains("polypeptide"), protein)
        .when(both, out("other nucleic acid chain", "dna/rna hybrid", 0.95))
        .when(p.contains("polydeoxyribonucleotide"), out("DNA chain", "DNA", 0.95))
        .when(p.contains("polyribonucleotide"), out("RNA chain", "RNA", 0.95))
        .otherwise(out("other polymer chain", None, 0.8))
    )
    single = F.when(F.coalesce(all_metal, F.lit(False)), out("metal ion", "ion", 0.95)).otherwise(out("small molecule compound", "ligand", 0.9))
    return (
        F.when(e == "polymer", chain)
        .when(e == "branched", out("glycan / branched component", "glycan", 0.95))
        .when(e == "non-polymer", single)
        .when(e == "water", out("other entity", "water", 0.9))
        .otherwise(out("other entity", None, 0.4))
    )
