"""Secrets in texts: three fixed patterns, and windows of high entropy.

Patterns alone miss keys of unknown format. Every run of key characters is therefore
scanned once more per character class: a window slides over the run, its counts change by
one character in and one out, and the windows above the class's limits are merged into
spans. Besides entropy, a class asks for letters and digits, or, where keys have few digits,
for changes between letters, cases and digits that words do not have. Spans that an
allow-list knows (UUIDs, checksums, data URLs, plain words joined by separators) are
suppressed; spans inside a pattern's span are that span already. Pattern spans are never
suppressed. Work is in proportion to the length of a text and the number of its spans.
"""

import hashlib
import math
import re
from bisect import bisect_right

from .rows import map_slices, row_and_text, texts_of

# The patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]+")
HEX_LEAST = 24
#: Finds the runs of ``HEX`` that are long enough, without stopping at every short one.
LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)

UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
CHECKSUM = re.compile(r"(?i:sha(?:1|224|256|384|512)[-_=].+)")
#: Candidates that look random and are no secrets: letters or digits joined by separators.
ALLOWED = (UUID, re.compile(r"(?:[A-Za-z]+|[0-9]+)(?:[-_/=+]+(?:[A-Za-z]+|[0-9]+))*[-_/=+]*"), CHECKSUM)
#: The same where digits are not asked for: words of one case, or with small letters after each capital.
WORD = r"(?:[A-Z]+|[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[0-9]+)"
PLAIN = (UUID, re.compile(rf"{WORD}(?:[-_/=+]+{WORD})*[-_/=+]*"), CHECKSUM)
#: Text just before a candidate that marks a checksum or an embedded file.
ALLOWED_BEFORE = re.compile(r"(?i:(?:sha-?(?:1|224|256|384|512)|md5|crc32|checksum|etag)[\"']?[ ]*[:=@][ ]*[\"']?|;base64,)$")
BEFORE_CHARS = 24

#: kind, characters, window, least entropy in bits a character, least letters, digits and changes
#: of class in a window, allow-list.
CLASSES = (
    ("entropy_hex", re.compile(r"[0-9A-Fa-f]+"), 20, 2.6, 3, 3, 0, ALLOWED),
    ("entropy_base32", re.compile(r"[A-Z2-7]+"), 24, 3.4, 6, 2, 0, ALLOWED),
    ("entropy_base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 20, 3.4, 4, 3, 0, ALLOWED),
    ("entropy_mixed", re.compile(r"[A-Za-z0-9+/_=-]+"), 20, 3.4, 4, 0, 4, PLAIN),
)
ORDER = ("assign", "access", "hex", *(c[0] for c in CLASSES))
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % min(c[2] for c in CLASSES))

SCALE = 1 << 32


def entropy_units(count):
    """count * log2(count) in whole units of 1 / SCALE, so that sums are exact."""
    return round(count * math.log2(count) * SCALE) if count else 0


def _change(before, ch):
    """Whether two neighbours change class. A small letter after a capital is no change, nor one beside a separator."""
    if not (before.isalnum() and ch.isalnum()):
        return False
    return before.isdigit() != ch.isdigit() or before.islower() and ch.isupper()


def hot_windows(run, width, least_bits, least_letters, least_digits, least_changes=0):
    """Merged (start, end) of the windows of ``run`` that reach all limits."""
    units = [entropy_units(c) for c in range(width + 1)]
    most = round(width * (math.log2(width) - least_bits) * SCALE)
    counts, total, letters, digits, changes, merged, before = {}, 0, 0, 0, 0, [], " "
    for i, ch in enumerate(run):
        if i >= width:
            gone = run[i - width]
            c = counts[gone]
            counts[gone] = c - 1
            total += units[c - 1] - units[c]
            letters -= gone.isalpha()
            digits -= gone.isdigit()
            if least_changes:
                changes -= _change(gone, run[i - width + 1])
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += units[c + 1] - units[c]
        letters += ch.isalpha()
        digits += ch.isdigit()
        if least_changes:
            changes += _change(before, ch)
            before = ch
        start = i - width + 1
        if start >= 0 and total <= most and letters >= least_letters and digits >= least_digits and changes >= least_changes:
            if merged and start <= merged[-1][1]:
                merged[-1][1] = i + 1
            else:
                merged.append([start, i + 1])
    return merged


def marked_before(text, start):
    return ALLOWED_BEFORE.search(text[max(0, start - BEFORE_CHARS) : start]) is not None


def pattern_spans(text):
    found = [
        ("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST
    ]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [("hex", m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    return found


def entropy_spans(text, known):
    """Spans of every class that no span of ``known`` holds."""
    starts, ends = [], []
    for _, start, end in sorted(known, key=lambda k: k[1]):
        starts.append(start)
        ends.append(max(end, ends[-1]) if ends else end)

    def held(start, end):
        before = bisect_right(starts, start)
        return before and ends[before - 1] >= end

    found = []
    for candidate in CANDIDATE.finditer(text):
        if marked_before(text, candidate.start()):
            continue
        passes = {id(p): not any(q.fullmatch(candidate[0]) for q in p) for p in (ALLOWED, PLAIN)}
        for kind, characters, width, *limits, patterns in CLASSES:
            if not passes[id(patterns)]:
                continue
            for run in characters.finditer(text, candidate.start(), candidate.end()):
                if run.end() - run.start() < width:
                    continue
                for a, b in hot_windows(run[0], width, *limits):
                    if not held(run.start() + a, run.start() + b):
                        found.append((kind, run.start() + a, run.start() + b))
    return found


def spans_of(text):
    """All spans (kind, start, end) of a text, and the pattern spans alone, both in order."""
    def place(span):
        return span[1], ORDER.index(span[0])

    known = pattern_spans(text)
    return sorted(known + entropy_spans(text, known), key=place), sorted(known, key=place)


def joined(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_secrets(docs, id_col="doc_id", text_col="text"):
    """One row per document: counts per pattern, a digest of the pattern spans, all spans.

    Null and empty texts have no spans. Repeated rows stay repeated. Other columns of
    ``docs`` are not read. Offsets are code points, ends exclusive.
    """

    def work(slices):
        for batch in slices:
            ids, texts = texts_of(batch, 0, 1)
            found = [spans_of(t) for t in texts]
            yield {
                "doc_id": ids,
                "n_assign": [sum(s[0] == "assign" for s in base) for _, base in found],
                "n_access": [sum(s[0] == "access" for s in base) for _, base in found],
                "n_hex": [sum(s[0] == "hex" for s in base) for _, base in found],
                "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for _, base in found],
                "spans": [joined(spans) for spans, _ in found],
                "n_spans": [len(spans) for spans, _ in found],
            }

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(
        docs.select(id_col, text_col),
        work,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long",
    )


def mask_spans(text):
    """Merged (start, end) of what masking takes.

    A key is hot in places only, so a span takes the whole candidate around it. An
    assignment holds its whole value already and leaves what stands before it.
    """
    spans = spans_of(text)[0]
    taken = [(start, end) for kind, start, end in spans if kind == "assign"]
    found = [(start, end) for kind, start, end in spans if kind != "assign"]
    at = 0
    for candidate in CANDIDATE.finditer(text):
        first, last = candidate.span()
        while at < len(found) and found[at][0] < first:
            at += 1
        hot = False
        while at < len(found) and found[at][0] < last:
            hot |= found[at][1] <= last
            at += 1
        if hot:
            taken.append((first, last))
    merged = []
    for start, end in sorted(taken):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged


def masked(text, mark="[SECRET]"):
    """The text with every span of ``mask_spans`` replaced by ``mark``."""
    out, at = [], 0
    for start, end in mask_spans(text):
        out += [text[at:start], mark]
        at = end
    return "".join(out) + text[at:] if out else text


def mask_secrets(docs, text_col="text", mark="[SECRET]"):
    """``docs`` with secrets in the text column replaced by ``mark``; null stays null.

    Texts go by in small slices, and every other column passes unchanged, whatever its name.
    Empty texts stay empty and repeated rows stay repeated.
    """
    frame, columns, back = row_and_text(docs, text_col)

    def work(slices):
        for batch in slices:
            texts = batch.column("text").to_pylist()
            yield {"row": batch.column("row"), "text": [None if t is None else masked(t, mark) for t in texts]}

    return back(map_slices(frame, work, f"{columns}, text string"))
