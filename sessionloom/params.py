"""Analysis-request parameters: a small JSON object read once on the driver."""

from __future__ import annotations

import json
import re

# Parameter names as they appear in the stored task JSON.
START_DATE = "startDate"
END_DATE = "endDate"
SEX = "sex"
PROFESSIONALS = "professionals"
SESSION_RATIO = "sessionRatio"
SAMPLE_TYPE = "sampleType"
START_AGE = "startAge"
END_AGE = "endAge"
CITIES = "cities"
KEYWORDS = "keywords"
CATEGORY_IDS = "categoryIds"

DEFAULT_RATIO = 0.01
MAX_RATIO = 0.1
BERNOULLI = "bernoulli"
POISSON = "poisson"

_BLANK = "".join(map(chr, range(0x21)))
_DECIMAL = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[fFdD]?", re.ASCII)


def get_param(params: dict, name: str) -> str | None:
    """The parameter as text, untrimmed; ``None`` where it is missing or blank."""
    value = params.get(name)
    if value is None:
        return None
    if not isinstance(value, str):
        value = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    return value if value.strip(_BLANK) else None


def get_list(params: dict, name: str) -> list[str] | None:
    """A comma list; items keep their spaces, empty items at the end do not count."""
    value = get_param(params, name)
    return None if value is None else value.rstrip(",").split(",")


def sample_ratio(params: dict) -> float:
    """Sampling ratio in (0, 0.1]; anything else falls back to one percent."""
    text = (get_param(params, SESSION_RATIO) or "").strip(_BLANK)
    if not _DECIMAL.fullmatch(text):
        return DEFAULT_RATIO
    ratio = float(text.rstrip("fFdD"))
    return ratio if 0 < ratio <= MAX_RATIO else DEFAULT_RATIO


def sample_type(params: dict) -> str:
    """Poisson only when asked for by exactly that word."""
    return POISSON if get_param(params, SAMPLE_TYPE) == POISSON else BERNOULLI


def task_id_from_args(args: list[str]) -> int:
    """The task id, first of the command-line arguments."""
    text = args[0] if args else None
    if text is None or not re.fullmatch(r"[+-]?\d+", text, re.ASCII):
        raise ValueError(f"not a task id: {text!r}")
    return int(text)


def parse_task_param(text: str | None, task_id: int | None = None) -> dict:
    """The task's JSON object; a task without filter parameters is refused."""
    try:
        params = json.loads(text) if text and text.strip(_BLANK) else None
    except json.JSONDecodeError as error:
        raise ValueError(f"task {task_id}: parameters are not JSON") from error
    if params is not None and not isinstance(params, dict):
        raise ValueError(f"task {task_id}: parameters are not a JSON object")
    if not params:
        raise ValueError(f"task {task_id}: empty parameters are not supported")
    return params
