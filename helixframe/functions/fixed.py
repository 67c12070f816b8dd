"""Fixed values of the formats and rules: chain classes, standard residues, radii, limits."""

from __future__ import annotations

# Chain types.
PROTEIN_TYPES = (
    "antibody heavy chain", "antibody light chain", "TCR chain", "MHC heavy chain",
    "beta2m or auxiliary immune chain", "peptide antigen", "other protein chain",
)
NUCLEIC_TYPES = ("DNA chain", "RNA chain", "other nucleic acid chain")
OTHER_POLYMER = "other polymer chain"
POLYMER_TYPES = (*PROTEIN_TYPES, *NUCLEIC_TYPES, OTHER_POLYMER)
GLYCAN, METAL, SMALL_MOLECULE = "glycan / branched component", "metal ion", "small molecule compound"
SUBORDINATE_TYPES = (GLYCAN, SMALL_MOLECULE, METAL)
ANTIBODY_TYPES = ("antibody heavy chain", "antibody light chain")
TCR, MHC, AUXILIARY, PEPTIDE = "TCR chain", "MHC heavy chain", "beta2m or auxiliary immune chain", "peptide antigen"
TCR_PMHC_TYPES = (TCR, MHC, AUXILIARY, PEPTIDE)

# Standard residues.
AMINO_ACIDS = (
    "ALA", "ARG", "ASN", "ASP", "CYS", "GLN", "GLU", "GLY", "HIS", "ILE", "LEU", "LYS", "MET", "PHE", "PRO", "SER", "THR", "TRP", "TYR", "VAL",
)
RNA_NUCLEOTIDES = ("A", "C", "G", "U", "I")
DNA_NUCLEOTIDES = ("DA", "DC", "DG", "DT", "DI", "DU")

# Limits of contacts and assemblies.
RESIDUE_CUTOFF, ATOM_CUTOFF = 8.0, 5.0
LEAST_RESIDUE_CONTACTS, LEAST_ATOM_CONTACTS = 3, 20
COVERAGE_CUTOFF = 4.5
PEPTIDE_LENGTH = 30

# Atoms a residue for estimates.
ATOMS_PER_RESIDUE = {"protein": 8, "nucleic": 20, "other": 5}

# Van der Waals radii of elements, in Angstrom.
RADII = {
    "B": 1.92, "C": 1.70, "N": 1.55, "O": 1.52, "F": 1.47, "P": 1.80, "S": 1.80, "SE": 1.90, "CL": 1.75, "BR": 1.85, "I": 1.98, "SI": 2.10,
    "NA": 2.27, "MG": 1.73, "K": 2.75, "CA": 2.31, "MN": 1.97, "FE": 1.94, "CO": 1.92, "NI": 1.63, "CU": 1.40, "ZN": 1.39, "CD": 1.58, "HG": 1.55,
}

# Immune annotation.
CDR_RANGES = {"cdr1": (27, 38), "cdr2": (56, 65), "cdr3": (105, 117)}
CHAIN_CODES = {"H": "heavy chain", "K": "kappa", "L": "lambda", "A": "alpha", "B": "beta", "G": "gamma", "D": "delta"}
CAMELIDS = ("alpaca", "llama", "camel", "camelid")
LINKER_MOTIFS = ("GGGGS", "GGGGSGGGGS", "GGGSGGGG", "SSGGGGSGGGG")
ANTIBODY_WORDS = ("antibody", "immunoglobulin", "fab", "fv", "nanobody", "vhh")
TCR_WORDS = ("t cell receptor", "t-cell receptor", "tcr")
DOMAIN_BITSCORE, DOMAIN_LIMIT = 80.0, 4

# Reports.
LOW_CONFIDENCE = 0.8
