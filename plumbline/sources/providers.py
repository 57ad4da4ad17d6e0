"""Model inference behind an interface: a provider says what it is and turns batches into batches.

Results carry the provider's revision. Recorded responses are flattened by expressions in `responses`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Provider(Protocol):
    name: str
    revision: str
    output: str  # DDL of the columns that infer() returns

    def infer(self, batch: pd.DataFrame) -> pd.DataFrame: ...


#: Revisions that move: what they name today is something else tomorrow.
MOVING = ("", "main", "master", "latest", "head")


def require_pin(provider: Provider, pins: dict[str, str]) -> None:
    """Refuses a provider without a pinned revision, with another one than its pin, or with a pin that moves."""
    pin = pins.get(provider.name)
    if pin is None or pin.strip().lower() in MOVING:
        raise ValueError(f"{provider.name} has no pinned revision")
    if provider.revision != pin:
        raise ValueError(f"{provider.name} is of revision {provider.revision}, pinned is {pin}")


def run(rows: DataFrame, provider: Provider, key: str = "id", batch: int = 64, pins: dict[str, str] | None = None) -> DataFrame:
    """(key, provider's columns, revision, error): one inference a row, in batches; a broken batch is tried row by row.

    With pins (name -> revision), a provider that isn't of its pinned revision is refused before anything is read.
    """
    if pins is not None:
        require_pin(provider, pins)
    names = [c.strip().split()[0] for c in provider.output.split(", ")]

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        out = provider.infer(frame)[names].reset_index(drop=True)
        out.insert(0, key, frame[key].to_numpy())
        out["error"] = None
        return out

    def infer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for i in range(0, len(f), batch):
                part = f.iloc[i : i + batch]
                try:
                    out = one(part)
                except Exception:  # find the rows that fail
                    singles = []
                    for k in range(len(part)):
                        try:
                            singles.append(one(part.iloc[k : k + 1]))
                        except Exception as e:
                            singles.append(pd.DataFrame({key: [part[key].iloc[k]], **{n: [None] for n in names}, "error": [str(e)[:200]]}))
                    out = pd.concat(singles, ignore_index=True)
                out["revision"] = provider.revision
                yield out[[key, *names, "revision", "error"]]

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInPandas(infer, f"{key} {kind}, {provider.output}, revision string, error string")
