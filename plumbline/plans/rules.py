"""How engines decide each signal, as configuration: signal -> (rule, engine columns)."""

from __future__ import annotations

SIGNALS: dict[str, tuple[str, list[str]]] = {
    "animal": ("all", ["detector", "describer"]),
    "weapon": ("any", ["detector", "describer"]),
    "monster": ("any", ["describer"]),
    "water": ("any", ["describer"]),
    "fire": ("any", ["describer"]),
    "silhouette": ("all", ["detector", "describer"]),
    # no rule is settled for persons; either engine counts until one is
    "person": ("any", ["detector", "describer"]),
}
