"""Settings of parsing and clustering: defaults, TOML files, checks, and what a resumed run may differ in."""

from __future__ import annotations

import dataclasses
import datetime
import tomllib
from dataclasses import dataclass

MODES = ("asymmetric_unit", "largest_assembly", "first_assembly", "all", "input_assembly")
#: Settings that a resumed run may change.
FREE = ("include_asym", "log_level", "verbose")


def strict_cutoff(value) -> str:
    """a date as YYYY-MM-DD, or an empty text for none."""
    if value is None or str(value).strip() == "":
        return ""
    text = value.isoformat() if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime) else str(value).strip()
    try:
        ok = len(text) == 10 and text[4] == text[7] == "-" and datetime.date.fromisoformat(text)
    except ValueError:
        ok = False
    if not ok:
        raise ValueError(f"cutoff_date is not of the form YYYY-MM-DD: {text}")
    return text


class _Checked:
    #: Field: (least, most); None is no bound.
    BOUNDS: dict[str, tuple[float | None, float | None]] = {}
    CHOICES: dict[str, tuple[str, ...]] = {}

    def __post_init__(self):
        for name, (least, most) in self.BOUNDS.items():
            value = getattr(self, name)
            if value is not None and ((least is not None and value < least) or (most is not None and value > most)):
                raise ValueError(f"{name} is {value}, not in [{'' if least is None else least}, {'' if most is None else most}]")
        for name, allowed in self.CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} is {getattr(self, name)!r}, not one of {', '.join(allowed)}")

    @classmethod
    def merged(cls, *layers: dict):
        """Later layers over earlier ones; a name that is no setting is an error."""
        known, out = {f.name for f in dataclasses.fields(cls)}, {}
        for layer in layers:
            if wrong := sorted(set(layer) - known):
                raise ValueError(f"unknown settings: {', '.join(wrong)}")
            out |= layer
        return cls(**out)

    def fingerprint(self) -> dict:
        """The settings that decide results."""
        return {k: v for k, v in sorted(dataclasses.asdict(self).items()) if k not in FREE}


_POSITIVE = 1e-12


@dataclass(slots=True)
class ParseSettings(_Checked):
    """settings of one parsing run."""

    assembly_mode: str = "asymmetric_unit"
    input_assembly: bool = False
    include_asym: bool = False
    metadata_cif_dir: str = ""
    metadata_table: str = ""
    coverage_mode: str = "nearest"
    output_format: str = "json"
    log_level: str = "DEBUG"
    verbose: bool = False
    debug: bool = False
    model: int = 1
    drop_hydrogens_for_analysis: bool = True
    max_polymer_chains: int = 100
    max_assembly_atoms: int = 300_000
    min_polymer_chain_length: int = 20
    tight_multimer_min_buried_area: float = 500.0
    tight_multimer_louvain_resolution: float = 1.0
    tight_multimer_min_member_instances: int = 2
    residue_contact_cutoff: float = 8.0
    atom_contact_cutoff: float = 5.0
    min_residue_contacts: int = 3
    min_atom_contacts: int = 20
    peptide_max_length: int = 30
    low_confidence_antibody_threshold: float = 0.8

    def __post_init__(self):
        self.log_level = self.log_level.upper()
        _Checked.__post_init__(self)
        if self.include_asym and not (self.input_assembly and self.metadata_cif_dir.strip()):
            raise ValueError("include_asym needs input_assembly and metadata_cif_dir")


ParseSettings.BOUNDS = {
    "model": (1, None), "max_polymer_chains": (1, None), "max_assembly_atoms": (1, None), "min_polymer_chain_length": (0, None), "tight_multimer_min_buried_area": (0, None),
    "tight_multimer_louvain_resolution": (_POSITIVE, None), "tight_multimer_min_member_instances": (2, None), "residue_contact_cutoff": (_POSITIVE, None), "atom_contact_cutoff": (_POSITIVE, None),
    "min_residue_contacts": (0, None), "min_atom_contacts": (0, None), "peptide_max_length": (1, None), "low_confidence_antibody_threshold": (0, 1),
}
_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
ParseSettings.CHOICES = {"assembly_mode": MODES, "coverage_mode": ("nearest",), "output_format": ("json", "csv"), "log_level": _LEVELS}


@dataclass(slots=True)
class ClusterSettings(_Checked):
    """settings of one clustering run."""

    protein_sequence_mode: str = "identity"
    protein_structure_mode: str = "greedy"
    cutoff_date: str = ""
    dimer_mode: str = "signature"
    multimer_mode: str = "signature"
    antibody_complex_mode: str = "signature"
    tcr_complex_mode: str = "signature"
    protein_min_seq_id: float = 0.40
    protein_coverage: float = 0.80
    tm_score_threshold: float = 0.50
    min_alignment_coverage_ratio: float = 0.50
    dimer_interface_residue_cutoff: float = 8.0
    antibody_complex_interface_residue_cutoff: float = 20.0
    multimer_max_atoms_for_refinement: int = 10_000
    model: int = 1
    log_level: str = "DEBUG"

    def __post_init__(self):
        self.log_level = self.log_level.upper()
        self.cutoff_date = strict_cutoff(self.cutoff_date)
        _Checked.__post_init__(self)


ClusterSettings.BOUNDS = {
    "protein_min_seq_id": (0, 1), "protein_coverage": (0, 1), "tm_score_threshold": (0, 1), "min_alignment_coverage_ratio": (0, 1), "dimer_interface_residue_cutoff": (_POSITIVE, None),
    "antibody_complex_interface_residue_cutoff": (_POSITIVE, None), "multimer_max_atoms_for_refinement": (1, None), "model": (1, None),
}
ClusterSettings.CHOICES = {
    "protein_sequence_mode": ("skip", "exact", "identity"), "protein_structure_mode": ("skip", "greedy"), "log_level": _LEVELS,
    **{f"{k}_mode": ("skip", "signature") for k in ("dimer", "multimer", "antibody_complex", "tcr_complex")},
}


def from_toml(text: str, overrides: dict | None = None) -> tuple[ParseSettings, ClusterSettings]:
    """The tables ``settings`` and ``clustering`` of a TOML text, under what the caller sets (by table)."""
    found, more = tomllib.loads(text), overrides or {}
    if wrong := sorted((set(found) | set(more)) - {"settings", "clustering"}):
        raise ValueError(f"unknown tables: {', '.join(wrong)}")
    layer = lambda name: (found.get(name, {}), more.get(name, {}))
    return ParseSettings.merged(*layer("settings")), ClusterSettings.merged(*layer("clustering"))


def changed(before: dict, now: dict) -> list[str]:
    """The settings in which two fingerprints differ, free ones aside."""
    return sorted(k for k in set(before) | set(now) if k not in FREE and before.get(k) != now.get(k))


def check_resume(before: dict | None, now: _Checked) -> None:
    """a run may resume only what was made with settings like its own."""
    differ = changed(before, now.fingerprint()) if before else []
    if differ:
        shown = ", ".join(differ[:8]) + (f", ... ({len(differ)} in all)" if len(differ) > 8 else "")
        raise ValueError(f"the existing run has other settings ({shown}); use a fresh folder")


def check_cutoff(settings: ClusterSettings, made_with: str) -> None:
    """F16: later stages have to use the cutoff that the sequence tables were made with."""
    if settings.cutoff_date != strict_cutoff(made_with):
        raise ValueError(f"cutoff {settings.cutoff_date or 'none'} differs from that of the sequence tables, {made_with or 'none'}")


def workers(asked: int | None, configured: int | None, shards: int) -> int:
    """Tasks of a stage: as asked, else as configured, else as many as there are shards."""
    return max(1, next(x for x in (asked, configured, shards) if x))
