"""Training-data operators. Nothing else in the package imports this subpackage."""

from importlib import import_module

MODULES = ("lang_id", "substring_dedup", "piece_codec", "suffix_dedup", "html_extract", "topk", "mixing", "near_dedup", "exact_dedup", "line_dedup")


def _all(name: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(import_module(f".{m}", __name__), name)
    return out


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLES")
