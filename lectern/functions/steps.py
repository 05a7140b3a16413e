"""Chain steps, payload rules and prompt templates."""

from __future__ import annotations

import re

# Chain steps by id, and the payload fields they own.
STEPS = {
    "0": "SPEAKER", "1": "COMBINE", "2": "NO_TOUCH", "3": "LEXICAL", "4": "DISFLUENCY",
    "5": "FORMAT", "6": "NUMERAL", "7": "PUNCT", "8": "CASING", "9": "REMAIN_FIX",
}
STEP_FIELDS = {
    "0": "ct_speaker", "1": "ct_combine", "3": "ct_lexical", "4": "ct_disfluency", "5": "ct_format",
    "6": "ct_numeral", "7": "ct_punct", "8": "ct_casing", "9": "ct_remain_fix",
}
# Keys of a payload.
REQUIRED = (
    "tokenization", "translation", "aggressiveness_level", "speaker_scope", "seg_start", "seg_end", "ct_speaker", "ct_combine",
    "no_touch_tokens", "ct_lexical", "ct_disfluency", "ct_format", "ct_numeral", "ct_punct", "ct_casing", "ct_remain_fix",
)
OPTIONAL = ("source_filename", "source_text", "corrected_text")
LEVELS = ("low", "medium", "high")
SCOPES = ("single", "multi", "unknown")
_IDS = {v: k for k, v in STEPS.items()}


_ITEM = r"""(?:"[^"]*"|'[^']*'|-?[\w.]+)"""
_LIST = re.compile(rf"\[\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*,?\s*)?\]")
_NAME_ONLY = re.compile(r"\[\s*[A-Za-z_]+\s*\]")


def expand_selector(selector) -> list[str]:
    """Values of a selector: every item of it (or the item that it is) may be a name, a
    list in brackets or names between commas. A single name in brackets is a name."""
    out: list[str] = []
    for item in [selector] if isinstance(selector, str) else selector or ():
        if not isinstance(item, str):
            continue
        text = item.strip()
        listed = _LIST.fullmatch(text) and not _NAME_ONLY.fullmatch(text)
        found = (x.strip("\"'") for x in re.findall(_ITEM, text)) if listed else text.split(",")
        out += filter(None, map(str.strip, found))
    return out


def step_id(token: str) -> str | None:
    name = token.strip().strip("[]").strip().upper()
    return name if name in STEPS else _IDS.get(name)


def resolve(selector) -> list[str]:
    """Step ids in order, once each. Any unknown value (or none) means all steps;
    NO_TOUCH is put before the first lexical or disfluency step."""
    ids = [step_id(v) for v in expand_selector(selector)]
    if not ids or None in ids:
        return list(STEPS)
    ids = list(dict.fromkeys(ids))
    first = next((k for k, i in enumerate(ids) if i in ("3", "4")), None)
    if first is not None and "2" not in ids:
        ids.insert(first, "2")
    return ids


def active_fields(selector) -> set[str]:
    return {STEP_FIELDS[i] for i in resolve(selector) if i in STEP_FIELDS}


def describe(selector) -> str:
    return ", ".join(f"{i}:{STEPS[i]}" for i in resolve(selector))


def payload_schema() -> dict:
    """JSON schema of a payload, as services take it that answer by schema."""
    text = {"type": "string"}
    texts = {"type": "array", "items": text}

    def one(properties: dict) -> dict:
        return {"type": "object", "additionalProperties": False, "properties": properties, "required": list(properties)}

    step = one({"edits": {"type": "array", "items": {**texts, "minItems": 2, "maxItems": 2}}, "result": text})
    level, scope = {"type": "string", "enum": list(LEVELS)}, {"type": "string", "enum": list(SCOPES)}
    known = {"tokenization": one({"tokens": texts}), "translation": text, "aggressiveness_level": level, "speaker_scope": scope, "seg_start": level, "seg_end": level, "no_touch_tokens": texts}
    return {"name": "patch_output", "strict": True, "schema": one({k: known.get(k, step) for k in REQUIRED})}
