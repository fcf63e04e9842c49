"""License scan: fuzzy search for short notices.

A notice with at most k edits is cut into k + 1 seeds; an occurrence with at most k edits holds at least one seed
unchanged (pigeonhole). Seeds are found exactly, the text around each is verified with the bounded-error
matching of the regex library, and the match's place and edits are kept. Edits must leave the words that tell one
license from another recognisable: numbers stand as they are, and a telling word has one edit at most, a short one a slip of
the finger, and is no other telling word. Notices are passages of license texts, and names in every form that
named_notices() makes.

Scale: one pass over the documents, no shuffle; the notices are a fixed, small table.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from caremill.llm.common import map_arrow, table, texts_of, words_of

#: The phrases whose exact places are counted, with their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices that are also found with edits: phrase, label, edits in characters. Base phrases stand between spaces, as whole words.
NOTICES = [
    ("released under the mit license", "mit", 3), ("licensed under the apache license version 2 0", "apache-2", 4), ("licensed under cc by nc 4 0", "cc-by-nc", 2),
    ("licensed under the gnu general public license", "gpl", 4), ("gnu lesser general public license", "lgpl", 3), ("gnu affero general public license", "agpl", 3),
    ("mozilla public license version 2", "mpl-2", 3), ("creative commons attribution", "cc-by", 2), ("creative commons attribution noncommercial", "cc-by-nc", 3), ("creative commons attribution non commercial", "cc-by-nc", 3),
    ("creative commons attribution sharealike", "cc-by-sa", 3), ("creative commons attribution share alike", "cc-by-sa", 3), ("creative commons attribution noderivatives", "cc-by-nd", 3), ("creative commons attribution noderivs", "cc-by-nd", 2),
    ("permission is hereby granted free of charge to any person obtaining a copy of the font software", "ofl", 6), ("redistribution and use in source and binary forms", "bsd", 4),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6), ("released into the public domain", "public-domain", 3),
    (" under the mit license ", "mit", 2), (" apache license version 2 ", "apache-2", 2), (" cc by nc ", "cc-by-nc", 1),
]
#: Licenses that go by a name: label, full names, short names, the version that the label means (None: any).
#: A short name that is also another thing's (an institute, a server) needs "license" near it.
NAMES = [
    ("mit", ["mit license"], [], ["mit"], None),
    ("apache-2", ["apache license", "apache software license"], [], ["apache"], "2"),
    ("gpl", ["gnu general public license", "gnu gpl"], ["gpl"], [], None),
    ("lgpl", ["gnu lesser general public license", "gnu lgpl"], ["lgpl"], [], None),
    ("agpl", ["gnu affero general public license", "gnu agpl"], ["agpl"], [], None),
    ("mpl-2", ["mozilla public license"], ["mpl"], [], "2"),
]
#: Rows of keys; a slip of the finger in a short word is one to the next key of its row.
KEYS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
#: Letters of a telling word up to which an edit must keep its length and be a slip.
SHORT = 4
#: Letters of a seed of a notice that is made from a name, at least; edits are allowed as far as seeds are that long, one in ten letters.
SEED = 6


def named_notices(names: list[tuple] = NAMES) -> list[tuple[str, str, int]]:
    """(phrase, label, edits) of each way to write a license's name: any verb may lead in, so none is part of a phrase.

    A full name stands by itself; a short one after "under", "under the" or "license identifier", or before "license"; one
    that is also another thing's after "licensed under" in place of "under". The version, where the label means one, follows
    the name as "version 2", "v2" or "2", each also with " 0".
    """
    out = []
    for label, full, short, shared, version in names:
        versions = [""] if version is None else [f"{form}{version}{zero}" for form in (" version ", " v", " ") for zero in ("", " 0")]
        forms = [f"{n}{v}" for n in full for v in versions]
        for some, leads in ((short, ("under", "under the")), (shared, ("licensed under", "licensed under the"))):
            forms += [form for n in some for v in versions for form in (*(f"{lead} {n}{v}" for lead in (*leads, "license identifier")), f"{n}{v} license")]
        out += [(f" {f} ", label, min((len(f) + 2) // 10, (len(f) + 2) // SEED - 1)) for f in forms]
    return sorted(out, key=lambda x: -len(x[0]))


#: Words of notices that tell licenses apart, with those of the names.
TELLING = frozenset("cc by nc sa nd commons attribution noncommercial sharealike noderivatives redistribution granted domain font bsd isc".split()) | {w for _, *names, _ in NAMES for some in names for n in some for w in n.split()} - {"license", "software"}
ALL_NOTICES = NOTICES + [n for n in named_notices() if n[0] not in {p for p, _, _ in NOTICES}]

SCAN = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, notices array<struct<label:string,first_word:int,end_word:int,edits:int>>"


def seeds_of(phrase: str, edits: int) -> list[tuple[int, str]]:
    """(offset, seed) of edits + 1 nearly equal pieces."""
    cuts = [len(phrase) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def occurrences(phrase: str, edits: int, first: regex.Pattern, best: regex.Pattern, text: str, a: int, b: int) -> Iterator[regex.Match]:
    """All occurrences in text[a:b] without overlaps, with the fewest edits of each: the best one near the first, then what is
    left on both sides of it. The space between two phrases that stand between spaces belongs to both."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if m := first.search(text, a, b):
            a = m.start()
            m = best.search(text, a, min(b, max(m.end(), a + len(phrase) + 3 * edits)))
            yield m
            todo += [(m.end() - phrase.endswith(" "), b), (a, m.start() + phrase.startswith(" "))]


def one_edit(a: str, b: str) -> bool:
    """Equal, or one letter added, dropped or changed, or two neighbours swapped."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def slip(a: str, b: str) -> bool:
    """Equal, or two neighbours swapped, or one letter typed on the next key of its row."""
    if len(a) != len(b):
        return False
    off = [i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y]
    if len(off) == 2 and off[1] == off[0] + 1:
        return a[off[0]] == b[off[1]] and a[off[1]] == b[off[0]]
    return not off or len(off) == 1 and any(a[off[0]] + b[off[0]] in row or b[off[0]] + a[off[0]] in row for row in KEYS)


def misspelt(word: str, found: str) -> bool:
    """Whether a word that was found may be a telling word: the same, or one edit from it and no other telling word."""
    return word == found or found not in TELLING and (slip if len(word) <= SHORT else one_edit)(word, found)


def digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def recognisable(phrase: str, text: str, a: int, b: int) -> bool:
    """Whether the numbers and telling words of the phrase stand in its match text[a:b], taken to whole words.

    Where a space was edited, a telling word may have grown together with its neighbours: it begins a found word, or ends one
    that is the word before it and itself. The digits are those of the phrase, in order.
    """
    a = text.rfind(" ", 0, a + 1) if text[a] != " " else a
    end = text.find(" ", b - 1)
    found, wanted = text[max(a, 0) : end if end >= 0 else len(text)].split(), phrase.split()
    if len(found) == len(wanted):
        return all(digits(w) == digits(x) and (w not in TELLING or misspelt(w, x)) for w, x in zip(wanted, found, strict=True))
    if digits("".join(found)) != digits(phrase):
        return False
    for before, w in zip(["", *wanted], wanted, strict=False):
        if w in TELLING:
            lengths = (len(w),) if len(w) <= SHORT else range(len(w) - 1, len(w) + 2)
            if not any(x == before + w or any(x[:n] == w or len(w) > SHORT and misspelt(w, x[:n]) for n in lengths) for x in found):
                return False
    return True


def outermost(found: list[tuple]) -> list[tuple]:
    """Matches that no longer match of another label holds."""
    out, ends = [], {}
    for x in sorted(found, key=lambda x: (x[0], -x[1])):
        _, b, label, *_ = x
        if not any(end >= b and other != label for other, end in ends.items()):
            out.append(x)
        ends[label] = max(ends.get(label, 0), b)
    return out


class Scanner:
    def __init__(self, base: dict[str, str] = BASE_PHRASES, notices: list[tuple[str, str, int]] = ALL_NOTICES):
        self.base = [(f" {p} ", label) for p, label in base.items()]
        self.notices = [(p, label, k, *(regex.compile(f"{flag}(?:{regex.escape(p)}){{e<={k}}}") for flag in ("", "(?b)"))) for p, label, k in notices]
        uses: dict[str, list[tuple[int, int]]] = {}
        for i, (p, _, k) in enumerate(notices):
            for offset, seed in seeds_of(p, k):
                uses.setdefault(seed, []).append((i, offset))
        self.seeds = ahocorasick.Automaton()
        for seed, places in uses.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()

    def exact(self, text: str) -> list[tuple[int, str]]:
        """(first word, label) of each place of a base phrase. ``text``: words with one space on each side."""
        found = []
        for phrase, label in self.base:
            at = text.find(phrase)
            while at >= 0:
                found.append((text.count(" ", 0, at), label))
                at = text.find(phrase, at + 1)
        return found

    def fuzzy(self, text: str) -> list[tuple[int, int, str, int, int]]:
        """(start, end, label, edits, letters of the notice) of the verified occurrences of each notice, without overlaps of one notice."""
        windows: dict[int, list[list[int]]] = {}
        for last, (n, uses) in self.seeds.iter(text):
            for i, offset in uses:
                phrase, _, k, *_ = self.notices[i]
                at = last + 1 - n - offset
                windows.setdefault(i, []).append([max(0, at - k), min(len(text), at + len(phrase) + k)])
        found, named = [], []
        for i in sorted(windows):
            phrase, label, k, first, best = self.notices[i]
            joined: list[list[int]] = []
            for a, b in sorted(windows[i]):
                if joined and a <= joined[-1][1]:
                    joined[-1][1] = max(b, joined[-1][1])
                else:
                    joined.append([a, b])
            places = [(m.start(), m.end(), label, sum(m.fuzzy_counts), len(phrase.strip())) for a, b in joined for m in occurrences(phrase, k, first, best, text, a, b) if recognisable(phrase, text, m.start(), m.end())]
            (named if phrase[0] == " " else found).extend(places)
        # of names of one label that share a place, the one with the fewest edits stays, then the longest; a notice goes first
        taken: dict[str, bytearray] = {}
        for a, b, label, *_ in found:
            taken.setdefault(label, bytearray(len(text)))[a:b] = b"\1" * (b - a)
        for x in sorted(named, key=lambda x: (x[3], x[0] - x[1], x)):
            a, b, label, *_ = x
            inner = taken.setdefault(label, bytearray(len(text)))
            if inner.find(1, a + 1, b - 1) < 0:
                inner[a + 1 : b - 1] = b"\1" * (b - a - 2)
                found.append(x)
        return outermost(found)

    def scan(self, raw: bytes) -> dict:
        words = words_of(raw)
        text = b" ".join([b"", *words, b""]).decode("utf-8", "surrogateescape") if words else ""
        places = self.exact(text)
        found = self.fuzzy(text) if text else []
        starts = [p for p, _ in places]
        base = {label for _, label in places}
        score = max([1.0] * bool(places) + [1 - edits / letters for *_, edits, letters in found], default=0.0)
        spans = [{"label": label, "first_word": text.count(" ", 0, a + 1) - 1 if text[a] != " " else text.count(" ", 0, a), "end_word": text.count(" ", 0, b - 1), "edits": edits} for a, b, label, edits, _ in sorted(found)]
        return {
            "n_words": len(words), "n_base": len(places), "first_word": min(starts, default=None), "last_word": max(starts, default=None), "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {x[2] for x in found})), "score": score, "notices": spans,
        }


KINDS = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "notices": pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int32()), ("end_word", pa.int32()), ("edits", pa.int32())]))}


def scan_licenses(docs: DataFrame, base: dict[str, str] = BASE_PHRASES, notices: list[tuple[str, str, int]] = ALL_NOTICES) -> DataFrame:
    """One row per document: counts, word places and labels, and the fuzzy notices with their word spans and edits.

    Null and empty texts have no words, no places, empty labels and score 0. Score: 1 for a base phrase, else the
    largest share of a notice's characters that needed no edit. Repeated rows are scanned one by one; extra
    columns are ignored.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for batch in parts:
            rows = [scanner.scan(t) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[k] for r in rows], kind) for k, kind in KINDS.items())], ["doc_id", *KINDS])

    ids = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, SCAN.replace("doc_id long", f"doc_id {ids}", 1))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
