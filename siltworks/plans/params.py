"""Merging parameter layers: global policy, theme, override file, options. Later layers win, key by key."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from siltworks.functions import fixed

log = logging.getLogger(__name__)

#: Policy keys that a stage reads, and the stage parameter that each sets.
STAGE_KEYS = {k: k for k in fixed.POLICY if k not in ("min_assistant_turns", "topic_match", "min_user_turns")} | {"min_user_turns": "min_turns"}
#: Known keys that no stage reads.
UNENFORCED = ("min_assistant_turns", "topic_match")
LEGAL = {*STAGE_KEYS, *UNENFORCED, "exclude_keywords"}
#: Parameters whose absence turns a stage off.
CLEARABLE = {"sig_ratio_min", "dedup_threshold", "topic_keywords", "exclude_keywords"}


class ConfigError(ValueError):
    """A layer of parameters or a direction is malformed."""


def load_object(path: str | Path, what: str = "configuration") -> dict[str, Any]:
    """A JSON object from a file of the driver's."""
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8"))
    except OSError as e:
        raise ConfigError(f"cannot read {what} {path}: {e}") from e
    except ValueError as e:
        raise ConfigError(f"{what} {path} is not valid JSON: {e}") from e
    if not isinstance(found, dict):
        raise ConfigError(f"{what} {path} must hold a JSON object")
    return found


def layer(values: Mapping[str, Any], name: str, clearing: bool = True) -> dict[str, Any]:
    """Stage parameters of one layer. ``None`` clears a parameter, where that has a meaning."""
    if unknown := sorted(set(values) - LEGAL):
        raise ConfigError(f"{name}: unknown keys {', '.join(unknown)}")
    out: dict[str, Any] = {}
    for key, value in values.items():
        if key in UNENFORCED:
            if value is None:
                raise ConfigError(f"{name}: {key} cannot be cleared, as it has no off state")
            log.info("%s sets %s, which no stage enforces", name, key)
            continue
        target = STAGE_KEYS.get(key, key)
        if value is None and not (clearing and target in CLEARABLE):
            raise ConfigError(f"{name}: {key} cannot be cleared, as its stage has no off state")
        out[target] = list(value) if isinstance(value, (list, tuple)) else value
    return out


def check_theme(theme: Mapping[str, Any], name: str) -> None:
    """Refuse older shapes: a policy block, a list beside the override, an override that is no object."""
    if "policy" in theme:
        raise ConfigError(f"theme {name}: a policy block is no longer read; use override")
    if "exclude_keywords" in theme:
        raise ConfigError(f"theme {name}: exclude_keywords belongs into override")
    if not isinstance(theme.get("override", {}), Mapping):
        raise ConfigError(f"theme {name}: override must be an object")


def theme_of(name: str, themes: Mapping[str, Any] | None = None) -> Mapping[str, Any]:
    known = fixed.THEMES if themes is None else themes
    if name not in known:
        raise ConfigError(f"no such theme: {name} (known: {', '.join(sorted(known)) or 'none'})")
    check_theme(known[name], name)
    return known[name]


def merge(
    policy: Mapping[str, Any] | None = None,
    theme: str | None = None,
    override: Mapping[str, Any] | None = None,
    themes: Mapping[str, Any] | None = None,
    *,
    min_turns: int | None = None,
    max_tool_ratio: float | None = None,
    no_end_turn: bool = False,
    min_user_msg_chars: int | None = None,
    max_first_msg_chars: int | None = None,
    topic_keywords: Sequence[str] | None = None,
    exclude_keywords: Sequence[str] | None = None,
    dedup_threshold: float | None = None,
    no_dedup: bool = False,
    sig_ratio_min: float | None = None,
    no_signature: bool = False,
) -> dict[str, Any]:
    """The parameters of a run. ``policy`` defaults to the global one.

    Clearing the dedup threshold wins over a value given beside it; a value of
    the signature floor wins over clearing it. Empty word lists count as absent.
    """
    p = layer(fixed.POLICY if policy is None else policy, "policy", clearing=False)
    if theme is not None:
        found = theme_of(theme, themes)
        if found.get("keywords"):
            p["topic_keywords"] = list(found["keywords"])
        p |= layer(found.get("override", {}), f"theme {theme}")
    if override:
        p |= layer(override, "override")
    options = {
        "min_turns": min_turns,
        "max_tool_ratio": max_tool_ratio,
        "min_user_msg_chars": min_user_msg_chars,
        "max_first_msg_chars": max_first_msg_chars,
        "topic_keywords": None if topic_keywords is None else list(topic_keywords),
        "exclude_keywords": None if exclude_keywords is None else list(exclude_keywords),
        "dedup_threshold": dedup_threshold,
    }
    p |= {k: v for k, v in options.items() if v is not None}
    if no_end_turn:
        p["require_end_turn"] = False
    if no_dedup:
        p["dedup_threshold"] = None
    if no_signature:
        p["sig_ratio_min"] = None
    if sig_ratio_min is not None:
        p["sig_ratio_min"] = sig_ratio_min
    for words in ("topic_keywords", "exclude_keywords"):
        if not p.get(words):
            p.pop(words, None)
    return p


def check_direction(direction: Mapping[str, Any], themes: Mapping[str, Any] | None = None) -> list[dict[str, Any]]:
    """The entries of a direction, each with its override merged over the direction's; raises before any scan."""
    if unknown := sorted(set(direction) - {"schema_version", "direction", "skill", "override", "themes", "_provenance"}):
        raise ConfigError(f"direction: unknown keys {', '.join(unknown)}")
    root, entries = direction.get("override", {}), direction.get("themes")
    if not isinstance(root, Mapping):
        raise ConfigError("direction: override must be an object")
    if not isinstance(entries, Sequence) or isinstance(entries, str) or not entries:
        raise ConfigError("direction: themes must be a non-empty list")
    seen: set[str] = set()
    out = []
    for e in entries:
        if not isinstance(e, Mapping) or not isinstance(e.get("theme"), str):
            raise ConfigError("direction: every entry must be an object that names a theme")
        own = e.get("override", {})
        if not isinstance(own, Mapping):
            raise ConfigError(f"direction: override of {e['theme']} must be an object")
        if e["theme"] in seen:
            raise ConfigError(f"direction: theme {e['theme']} is listed twice")
        seen.add(e["theme"])
        report_only = bool(theme_of(e["theme"], themes).get("report_only"))
        out.append({"theme": e["theme"], "override": {**root, **own}, "report_only": report_only})
    return out
