import random
import re

import regex

from procura.llm import notices
from procura.llm.queries import op5_license_notices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _base(text):
    w = WORD.findall(_lower(text))
    out = [(label, i) for p, label in notices.PHRASES for q in [p.split()] for i in range(len(w)) if w[i:i + len(q)] == q]
    return len(w), sorted(out)


def _texts():
    rng = random.Random(7)
    filler = ["by", "cc", "all", "rights", "general", "public", "the", "é", "Ünited", "x1", "日本"]
    out = [None, "", " ", "CC BY", "cc-by cc by", "all rights reserved", "All  Rights\nRESERVED!", "all-rights-reserved", "cc bys"]
    for _ in range(150):
        parts = rng.choices(filler, k=rng.randrange(30))
        for phrase, _ in rng.choices(notices.NOTICES, k=2):
            p = list(phrase)
            for _ in range(rng.randrange(6)):
                i = rng.randrange(len(p))
                p[i:i + rng.randrange(2)] = rng.choice(["", "q", "z"])
            parts.insert(rng.randrange(len(parts) + 1), "".join(p))
        out.append(rng.choice([" ", ", ", "\n"]).join(parts))
    return out


def test_places_and_labels_equal_brute_force():
    find = notices.finder(notices.PHRASES, notices.NOTICES, notices.LETTERS_AN_ERROR)
    for text in _texts():
        n, exact, fuzzy = find(text)
        assert (n, sorted((x["label"], x["word"]) for x in exact)) == _base(text)
        line = " " + " ".join(WORD.findall(_lower(text))) + " "
        want = set()
        for phrase, label in notices.NOTICES:
            k = len(phrase) // notices.LETTERS_AN_ERROR
            if regex.search(rf"(?<= )(?:{regex.escape(phrase)}){{e<={k}}}(?= )", line):
                want.add(label)
        assert {x["label"] for x in fuzzy} == want
        for x in fuzzy:
            assert f" {x['text']} " in line


def test_pieces_cover_the_phrase():
    for phrase, _ in notices.NOTICES:
        for k in range(5):
            assert "".join(p for p, _ in notices.seeds(phrase, k)) == phrase and len(notices.seeds(phrase, k)) == k + 1


def test_rows(spark, tmp_path):
    schema = "doc_id long, text string, exact string, fuzzy int"
    rows = [(None, None, "x", 1), (1, "", "x", 1), (1, "", "x", 1), (2, "word " * 300_000 + "cc by", "x", 1), (3, "al rights reserved cc by", "x", 1)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op5_license_notices(spark, str(tmp_path)).collect()}
    assert got[2]["first_word"] == 300_000 and got[2]["n_words"] == 300_002
    assert (got[3]["base_labels"], got[3]["labels"], got[3]["n_base"]) == ("cc-by", "cc-by,reserved", 1)
    assert got[1]["first_word"] is None and got[1]["labels"] == "" and got[1]["score"] == 0.0
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op5_license_notices(spark, f"{tmp_path}/none").count() == 0


def test_places_in_a_long_text_take_linear_time():
    import time
    find = notices.finder(notices.PHRASES, notices.NOTICES, notices.LETTERS_AN_ERROR)
    notice = notices.NOTICES[3]
    notice = notice[0] if isinstance(notice, tuple) else notice

    def seconds(n):
        t = time.process_time()
        _, _, fuzzy = find((notice + " some other words ") * n)
        assert len(fuzzy) >= n and [x["word"] for x in fuzzy] == sorted(x["word"] for x in fuzzy)
        return time.process_time() - t

    small = seconds(500)
    assert seconds(4_000) < 24 * max(small, 0.02)
