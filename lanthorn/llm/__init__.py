"""Operators for large-scale training-data pipelines (one module per operator)."""

import importlib

_MODULES = ["q_fingerprint", "q_fptree", "q_jaccard", "q_langid", "q_merkle", "q_mix", "q_pieces", "q_pii", "q_quality_cnn", "q_quality_rules", "q_sarray", "q_secret_scan", "q_tokens"]
_loaded: tuple[dict, dict] | None = None


def load_queries():
    """(queries, oracle SQL) of the subpackage, keyed by query name."""
    global _loaded
    if _loaded is None:
        queries, oracles = {}, {}
        for name in _MODULES:
            m = importlib.import_module(f"lanthorn.llm.{name}")
            queries.update(m.QUERIES)
            oracles.update(getattr(m, "ORACLES", {}))
        _loaded = queries, oracles
    return _loaded
