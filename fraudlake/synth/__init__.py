"""Synthetic transactions: seed rows, a Gaussian copula learnt from rows, injected patterns."""

from fraudlake.synth.copula import CopulaModel, fit, sample
from fraudlake.synth.generate import generate, row_ids
from fraudlake.synth.patterns import inject_patterns
from fraudlake.synth.seeds import seed_rows
from fraudlake.synth.stored import STATED_MODEL, StoredModel, load_model, sample_stored, save_model

__all__ = [
    "STATED_MODEL",
    "CopulaModel",
    "StoredModel",
    "fit",
    "generate",
    "inject_patterns",
    "load_model",
    "row_ids",
    "sample",
    "sample_stored",
    "save_model",
    "seed_rows",
]
