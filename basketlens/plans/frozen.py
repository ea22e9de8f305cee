"""A frozen network and calibrator with weights from a rule, for reproducible scores."""

from __future__ import annotations

from basketlens.contracts import RESPONSE_FEATURES
from basketlens.operators.response import Calibrator, FeedForward

HIDDEN_UNITS = 4

FROZEN_NETWORK = FeedForward(
    hidden_weights=tuple(
        tuple(((3 * i + 5 * j) % 7 - 3) / 8.0 for i in range(len(RESPONSE_FEATURES)))
        for j in range(HIDDEN_UNITS)),
    hidden_bias=tuple((j - 1) / 4.0 for j in range(HIDDEN_UNITS)),
    output_weights=tuple(0.5 if j % 2 == 0 else -0.25 for j in range(HIDDEN_UNITS)),
    output_bias=-1.5)

FROZEN_CALIBRATOR = Calibrator(slope=0.8, intercept=-0.3)
