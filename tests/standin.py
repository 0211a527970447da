"""A deterministic responder for tests."""

import hashlib
import json
import re

from ideaweave.config import CONSTELLATION_TYPES


def fake_responder(prompt: str, system: str):
    """Deterministic stand-in for a model: a pure function of the prompt text.

    It names the first three ``[ID:n]`` items in a constellation (or pattern) whose type and
    score come from the prompt's SHA-256. Token counts are characters // 4.
    """
    h = hashlib.sha256(prompt.encode("utf-8")).hexdigest()
    ids = [int(x) for x in re.findall(r"\[ID:(\d+)\]", prompt)][:3]
    if '"patterns"' in prompt:
        body = {"patterns": [{"name": f"theme {h[:6]}", "idea_ids": ids, "explanation": f"shared by {len(ids)}"}]}
    else:
        kind = CONSTELLATION_TYPES[int(h[0], 16) % 5]
        c = {"type": kind, "idea_ids": ids, "title": f"group {h[:6]}", "explanation": f"items {ids}",
             "score": int(h[1:3], 16) % 10 + 1}
        if kind == "absence":
            c["actionability"] = int(h[3:5], 16) % 14 + 0.5
        body = {"constellations": [c]}
    text = "Here is what I found:\n" + json.dumps(body)
    return text, len(prompt) // 4, len(text) // 4
