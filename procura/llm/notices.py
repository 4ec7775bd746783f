"""License notices: exact phrases, and fuzzy search for short notices.

A notice of length m may have m / 10 errors (insertions, deletions, changes).
Cut into one piece more than it has errors, one piece must stand in the text
unchanged: these seeds are found by plain search, and only the text around a
seed goes to the ``regex`` library's bounded-error matching, which verifies the
edits and gives the span.
"""

from __future__ import annotations

import regex
from pyspark.sql import DataFrame

from procura.llm.common import per_text

#: places of these are counted; fixed by the query's contract
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: notices that are searched with errors
NOTICES = (*PHRASES, ("creative commons attribution", "cc-by"), ("licensed under the apache license", "apache"),
           ("permission is hereby granted free of charge", "mit"), ("released under the mit license", "mit"),
           ("redistribution and use in source and binary forms", "bsd"), ("mozilla public license", "mpl"),
           ("released into the public domain", "public-domain"))
#: letters of a notice for each error allowed
LETTERS_AN_ERROR = 10
#: ASCII other than letters and digits parts words; all else belongs to them
_APART = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_APART).split()


def seeds(phrase: str, errors: int) -> list[tuple[str, int]]:
    """``errors`` + 1 pieces of the phrase and where they begin."""
    cuts = [len(phrase) * i // (errors + 1) for i in range(errors + 2)]
    return [(phrase[a:b], a) for a, b in zip(cuts, cuts[1:])]


def _places(line: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase's words stand; ``line``: the words, each
    between single spaces."""
    out, target, at, counted, word = [], b" " + phrase + b" ", line.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        word += line.count(b" ", counted, at)
        counted = at
        out.append(word)
        at = line.find(target, at + 1)
    return out


def finder(phrases, notices, letters: int):
    """A function of a text: number of words, exact places, fuzzy matches."""
    plan = []
    for phrase, label in notices:
        k = len(phrase) // letters
        pattern = regex.compile(rf"(?e)(?<= )(?:{regex.escape(phrase)}){{e<={k}}}(?= )")
        plan.append((label, len(phrase), k, seeds(phrase, k), pattern))

    def windows(line: str, length: int, k: int, pieces) -> list[list[int]]:
        spans = []
        for piece, begin in pieces:
            at = line.find(piece)
            while at >= 0:
                spans.append([max(0, at - begin - k - 1), at - begin + length + k + 2])
                at = line.find(piece, at + 1)
        out: list[list[int]] = []
        for a, b in sorted(spans):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return out

    def find(text: str | None):
        own = words(text)
        line = b" " + b" ".join(own) + b" "
        exact = [{"label": label, "word": w} for phrase, label in phrases for w in _places(line, phrase.encode())]
        fuzzy, decoded = [], None
        for label, length, k, pieces, pattern in plan:
            if not any(p.encode() in line for p, _ in pieces):
                continue
            decoded = decoded or line.decode()
            at = word = 0
            for a, b in windows(decoded, length, k, pieces):
                for m in pattern.finditer(decoded, a, b):
                    # matches come in order: words are counted on from the last one
                    word += decoded.count(" ", at, m.start())
                    at = m.start()
                    fuzzy.append({"label": label, "word": word - 1,
                                  "errors": sum(m.fuzzy_counts), "text": m.group()})
        return len(own), exact, fuzzy

    return find


def license_notices(docs: DataFrame, phrases=PHRASES, notices=NOTICES, letters_an_error: int = LETTERS_AN_ERROR) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, exact (places of the phrases: label
    and word number) and fuzzy (matches of the notices: label, number of the
    first word, errors and the text found, words parted by one space).

    Null and empty text: no words, empty lists.  Null doc_id and repeated rows:
    rows like any other.  Other columns are ignored; empty input gives no rows."""
    def start():
        find = finder(phrases, notices, letters_an_error)

        def run(texts):
            return list(zip(*map(find, texts))) if texts else [[], [], []]
        return run

    return per_text(docs, ["doc_id"], {"n_words": "long", "exact": "array<struct<label:string,word:long>>",
                                       "fuzzy": "array<struct<label:string,word:long,errors:int,text:string>>"}, start)
