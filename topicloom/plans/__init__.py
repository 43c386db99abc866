"""The three steps, each one lazy plan, and the whole run over stored tables."""

from .categorise import categorise, text_features
from .extract import extract_documents
from .rank import model_input, register_views
from .run import apply_step, run

__all__ = [
    "apply_step",
    "categorise",
    "extract_documents",
    "model_input",
    "register_views",
    "run",
    "text_features",
]
