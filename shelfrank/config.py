"""Defaults and errors shared by the package."""

from __future__ import annotations

from dataclasses import dataclass


class NotFittedError(Exception):
    """A model was asked to predict before it was fitted."""


class EmptyDataFrameError(ValueError):
    """An input that must hold rows is empty."""


# Documented defaults.
@dataclass(frozen=True)
class Defaults:
    seed: int = 42
    k: int = 5
    alpha: float = 1.0
    exploration_coef: float = 2.0
    price_weight: float = 0.3
    hybrid_weights: tuple[float, float] = (0.7, 0.3)
    similarity_threshold: float = 0.0
    neighbours: int = 5
    max_seq_len: int = 50
    session_len: int = 10
    temporal_decay: float = 0.8
    dcg_gamma: float = 0.85
    noise_mean: float = 0.1
    noise_std: float = 0.05
    walk_length: int = 8
    walks_per_node: int = 40
    embedding_dim: int = 32
    window_size: int = 4
    epochs: int = 3
    last_train_iter: int = 3


DEFAULTS = Defaults()
