"""Header profiles: the words that name the role of a column.

A profile is an immutable value that is handed to operators; there is no
global state. Role weights and markers for page triage derive from it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

ROLES = ("alias", "purchase", "particulars", "pack")
#: Default weights of the roles in page triage.
DEFAULT_WEIGHTS = {"alias": 2, "purchase": 3, "pack": 2, "particulars": 2}
#: The synonyms of the default profile.
DEFAULT_SYNONYMS = {
    "alias": ["reference", "reference no", "ref no", "ref.", "item code", "code", "product code", "part no", "part number", "article no", "article", "catalog no", "model no", "alias", "sku", "cat.nos", "cat nos"],
    "purchase": ["mrp", "unit mrp", "unit price", "price", "₹", "purchase", "purchase price", "rate", "net rate", "list price", "mrp* /unit", "unit lp"],
    "particulars": ["particular", "particulars", "description", "item description", "product", "material", "name"],
    "pack": ["pack", "std pkg", "std. pkg", "std. pkg. (nos.)", "pkg", "pack size", "uom"],
}


def normalized(text: str) -> str:
    """Lower case, currency signs as the word inr, all else but a-z, 0-9 as single spaces."""
    marked = "".join(" inr " if c in "₹`" else c if c.isascii() and c.isalnum() else " " for c in text.lower())
    return " ".join(marked.split())


@dataclass(frozen=True)
class Profile:
    """Synonyms by role, and weights of the roles."""

    synonyms: dict[str, list[str]] = field(default_factory=lambda: {r: list(DEFAULT_SYNONYMS[r]) for r in ROLES})
    weights: dict[str, int] = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))

    def markers(self, role: str, with_name: bool = True) -> list[str]:
        """Distinct normalized synonyms of a role in order; its name last."""
        raw = [*self.synonyms.get(role, []), *([role] if with_name else [])]
        return [m for m in dict.fromkeys(map(normalized, raw)) if m]

    def page_markers(self, role: str) -> list[str]:
        """Distinct synonyms of a role, in lower case with single spaces, to be sought in page text."""
        return [m for m in dict.fromkeys(" ".join(s.lower().split()) for s in self.synonyms.get(role, [])) if m]

    def keyword_weights(self, overrides: dict[str, int] | None = None) -> dict[str, int]:
        """The greatest weight of each keyword over the roles; the roles' names count as well."""
        out: dict[str, int] = {}
        for role in self.synonyms:
            for key in self.page_markers(role):
                out[key] = max(out.get(key, 0), self.weights.get(role, 1))
        for role, weight in self.weights.items():
            out[role] = max(out.get(role, 0), weight)
        for key, weight in (overrides or {}).items():
            if isinstance(key, str) and key.strip() and type(weight) is int:
                out[key.strip().lower()] = weight
        return {k: w for k, w in out.items() if w > 0 or k in (overrides or {})}


def read_profile(path: str | Path) -> Profile:
    """A profile from a JSON file: four lists that must not be empty, and triage.role_weights if given."""
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(data, dict):
        raise ValueError(f"a profile is a JSON object: {path}")
    synonyms = {}
    for role in ROLES:
        words = [str(w).strip() for w in data.get(role) or [] if str(w).strip()] if isinstance(data.get(role), list) else []
        if not words:
            raise ValueError(f"profile {path} lacks words for {role}")
        synonyms[role] = words
    triage = data.get("triage")
    given = triage.get("role_weights") if isinstance(triage, dict) else None
    weights = DEFAULT_WEIGHTS | {r: w for r, w in (given or {}).items() if r in ROLES and type(w) is int}
    return Profile(synonyms, weights)


def read_keyword_weights(path: str | Path) -> dict[str, int]:
    """Overrides of keyword weights from a JSON object; entries that are no words with whole numbers are left out."""
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(data, dict):
        raise ValueError(f"keyword weights are a JSON object: {path}")
    return {k.strip().lower(): w for k, w in data.items() if k.strip() and isinstance(w, int)}


def find_profile(document: str, folder: str | Path, explicit: str | Path | None = None, *, required: bool = False) -> Profile:
    """The profile given, else the one named like the document, else default.json.

    If there is none, the built-in one, or, with ``required``, an error.
    """
    if explicit:
        return read_profile(explicit)
    for name in (Path(document).stem, "default"):
        if (path := Path(folder) / f"{name}.json").is_file():
            return read_profile(path)
    if required:
        raise FileNotFoundError(f"no header profile for {document} in {folder}")
    return Profile()
