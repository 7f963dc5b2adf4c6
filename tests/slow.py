"""Slow forms of what the library does, written from the rules."""

import re

from loomsift.functions import guards
from loomsift.operators import dedup


def slow_redaction(t):
    """Character by character: the leftmost finding that begins where nothing was replaced, the shortest of equal starts."""
    found, out, k = sorted(guards.secret_spans(t), key=lambda x: x[2:]), [], 0
    while k < len(t):
        here = [x for x in found if x[2] == k]
        if here:
            out.append(f"«REDACTED:{here[0][0]}»")
            k = here[0][3]
        else:
            out.append(t[k])
            k += 1
    return "".join(out)


def slow_anchors(t):
    """Every kind in turn marks the characters it takes."""
    taken, out = [False] * len(t), []
    for kind, p in guards.ANCHORS.items():
        for m in re.finditer(p, t):
            if not any(taken[m.start() : m.end()]):
                taken[m.start() : m.end()] = [True] * (m.end() - m.start())
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda x: x[1:])


def slow_sections(t):
    """Line by line: a heading is a line of 3 to 60 characters that begins with a capital, perhaps after a number, ends in no
    mark, and has at most eight words."""
    lines, k, out, heading, body = t.split("\n"), 0, [], None, []

    def name(line):
        m = re.fullmatch(r"\s*(?:(?:\d+|[IVXLC]+)[.)]\s+)?([A-Z][^\n]{1,58}[^\s.:;,!?])\s*", line)
        return m[1] if m and len(m[1].split()) <= 8 else None

    def close():
        text = "\n".join(body).strip()
        if text and heading is not None:
            out.append((heading, text))

    while k < len(lines):
        line = lines[k]
        if re.fullmatch(r"\s*(?:\d+|[IVXLC]+)[.)]\s*", line):  # a number alone: with the next line that isn't blank
            n = next((j for j in range(k + 1, len(lines)) if lines[j].strip()), None)
            if n is not None and re.fullmatch(r"[A-Z].*", lines[n].lstrip()) and name(lines[n]):
                k, line = n, lines[n]
        if (h := name(line)) is not None:
            close()
            heading, body = h, []
        else:
            body.append(line)
        k += 1
    if heading is None:
        return [("", t.strip())] if t.strip() else []
    close()
    return out


def slow_cascade(batch, staged, threshold):
    """Rows (uid, title, tier, seq) of the batch one by one against every live row."""
    live, out = [x[:3] for x in sorted(staged, key=lambda x: x[3])], []
    for uid, title, tier, seq in sorted(batch, key=lambda x: x[3]):
        action, match, score = "new", None, 0.0
        if uid in {x[0] for x in live}:
            action, match, score = "duplicate_id", uid, 100.0
        else:
            first = list(dict.fromkeys(x[1] for x in live))
            best, k = max(((dedup.ratio(title, t), -k) for k, t in enumerate(first)), default=(0.0, 0))
            if best >= threshold:
                found = [x for x in live if x[1] == first[-k]][-1]
                action, match, score = "supersedes" if tier < found[2] else "duplicate_fuzzy", found[0], best
        if action == "supersedes":
            live = [x for x in live if x[0] != match]
        if action in ("new", "supersedes"):
            live.append((uid, title, tier))
        out.append((uid, seq, action, match, round(score, 6)))
    return out
