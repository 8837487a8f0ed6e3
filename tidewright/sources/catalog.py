"""Load source tables as a catalogue says."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from .tables import extract


def load(
    catalogue: Mapping[str, Sequence[str]],
    name: str,
    source: DataFrame,
    target: DataFrame | None,
    mode: str | None = None,
    **options,
) -> DataFrame:
    """Rows to load for a table of ``catalogue`` (name -> modes); by default its last mode."""
    known = catalogue[name]
    chosen = known[-1] if mode is None else mode
    if chosen not in known:
        raise ValueError(f"{name} is not loaded {chosen}")
    return extract(source, target, chosen, **options)
