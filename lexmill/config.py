"""Job parameters, their defaults and their validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, fields
from typing import Any

# The default English stop list, 131 lower-case words.
STOP_WORDS: tuple[str, ...] = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves",
    "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "m", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is",
    "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a",
    "an", "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with",
    "about", "against", "between", "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here", "there",
    "when", "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "http", "https", "amp",
)

# The filler for missing fields and the name of the out-of-vocabulary entry.
MISSING_FILL = "nanvazio"
OOV_WORD = "***UNK***"
OOV_INDEX = 1


class JobConfigError(ValueError):
    """A job was given parameters, datasets or columns it cannot work with."""


@dataclass(frozen=True)
class TrainingParams:
    """What a training run needs, stored with the model so a retrain can repeat it.

    ``max_rows`` is the documented bound on the labelled rows a fit uses: a seeded sample of that many rows, or the first
    ones in a retrain. ``selected_columns`` are those whose missing values are repaired, features and target if
    not given; it may name more. Training deals the documents to ``shards`` whose weights are averaged
    ``averages_per_epoch`` times in each epoch; both are settings of the algorithm and never follow the data.
    """

    feature_columns: tuple[str, ...] = ("text",)
    target_column: str = "label"
    selected_columns: tuple[str, ...] | None = None
    separator: str = ","
    encoding: str = "utf-8"
    stop_words: tuple[str, ...] = STOP_WORDS
    remove_stop_words: bool = True
    drop_missing: bool = False
    max_rows: int = 50_000
    num_words: int | None = None
    holdout_share: float = 0.30
    neurons: int = 5
    use_dropout: bool = False
    dropout_rate: float = 0.4
    batch_size: int = 32
    epochs: int = 10
    accuracy_tolerance: float = 0.02
    seed: int = 1
    cap_seed: int = 0
    shards: int = 8
    averages_per_epoch: int = 2

    def __post_init__(self) -> None:
        if not self.feature_columns:
            raise JobConfigError("feature_columns must name at least one column")
        if not 0.0 < self.holdout_share < 1.0:
            raise JobConfigError(f"holdout_share must lie between 0 and 1, got {self.holdout_share}")
        if self.num_words is not None and self.num_words < 2:
            raise JobConfigError(f"num_words must be at least 2, got {self.num_words}")
        for name in ("max_rows", "neurons", "batch_size", "epochs", "shards", "averages_per_epoch"):
            if getattr(self, name) < 1:
                raise JobConfigError(f"{name} must be at least 1, got {getattr(self, name)}")
        if not 0.0 <= self.dropout_rate < 1.0:
            raise JobConfigError(f"dropout_rate must lie in [0, 1), got {self.dropout_rate}")

    @property
    def used_columns(self) -> list[str]:
        """The columns a job reads and repairs, each once."""
        return list(dict.fromkeys([*(self.selected_columns or ()), *self.feature_columns, self.target_column]))

    @classmethod
    def from_mapping(cls, values: Mapping[str, Any]) -> "TrainingParams":
        """Build from a stored mapping; seeds, sharding, selected columns and the missing-value policy have defaults."""
        names = [f.name for f in fields(cls)]
        optional = ("seed", "cap_seed", "drop_missing", "selected_columns", "shards", "averages_per_epoch")
        require_keys(values, [n for n in names if n not in optional], "parameter")
        unknown = sorted(set(values) - set(names))
        if unknown:
            raise JobConfigError(f"unknown parameter(s): {', '.join(unknown)}")
        kept = dict(values)
        kept["feature_columns"] = tuple(kept["feature_columns"])
        kept["stop_words"] = tuple(kept["stop_words"])
        if kept.get("selected_columns") is not None:
            kept["selected_columns"] = tuple(kept["selected_columns"])
        return cls(**kept)

    def as_mapping(self) -> dict[str, Any]:
        out = asdict(self)
        out["feature_columns"] = list(self.feature_columns)
        out["stop_words"] = list(self.stop_words)
        if self.selected_columns is not None:
            out["selected_columns"] = list(self.selected_columns)
        return out


@dataclass(frozen=True)
class ModelName:
    """Which model a job builds and where its runs are filed."""

    name: str = "text_classifier"
    experiment: str = "text-classification"
    tags: Mapping[str, str] = field(default_factory=dict)


def require_keys(values: Mapping[str, Any], names: Sequence[str], what: str) -> None:
    missing = [n for n in names if n not in values]
    if missing:
        raise JobConfigError(f"missing {what}(s): {', '.join(missing)}")


def require_columns(available: Sequence[str], wanted: Sequence[str], what: str) -> None:
    missing = [c for c in wanted if c not in available]
    if missing:
        raise JobConfigError(f"{what} column(s) not found: {', '.join(missing)}; available: {', '.join(available)}")
