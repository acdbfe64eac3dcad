import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    text = text or ""
    def digits(m):
        return re.sub("[^0-9]", "", m.group())
    return (
        [("email", *m.span()) for m in EMAIL.finditer(text)]
        + [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        + [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
        + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15])


def base(text):
    return [tuple(s[:3]) for s in pii.find(text) if s.base]


@pytest.mark.parametrize("alphabet", ["a@.1-2 +9", "0123456789 -.", "+1 ().-2x", "a@b.c @\n"])
def test_plain_spans_are_those_of_the_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert base(text) == brute(text), text


def test_plain_spans_of_real_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]] for r in pii.detect(docs).collect()}
    assert got == {r["doc_id"]: brute(r["text"]) for r in docs.collect()}
    assert any(got.values())


@pytest.mark.parametrize("text, kind, want", [
    ("mail jo.doe [at] example [dot] com now", "email", "jo.doe [at] example [dot] com"),
    ("mail jo (at) mail.example.org, thanks", "email", "jo (at) mail.example.org"),
    ("mail jo at example dot co dot uk please", "email", "jo at example dot co dot uk"),
    ("an jo ät beispiel punkt de schreiben", "email", "jo ät beispiel punkt de"),
    ("escribe a jo arroba correo punto es hoy", "email", "jo arroba correo punto es"),
    ("jo @ example.com", "email", "jo @ example.com"),
    ("from Ｊｏ＠ｅｘａｍｐｌｅ．ｃｏｍ to", "email", "Ｊｏ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("jо.dое@ехаmple.com", "email", "jо.dое@ехаmple.com"),
    ("call plus one five five five one two three four five six seven please", "phone",
     "plus one five five five one two three four five six seven"),
    ("at one nine two dot one six eight dot one dot nine end", "ip", "one nine two dot one six eight dot one dot nine"),
    ("card four one one one, one one one one one one one one one one one one.", "card",
     "four one one one, one one one one one one one one one one one one"),
    ("4​111 1111 1111 1111", "card", "4​111 1111 1111 1111"),
    ("٤١١١١١١١١١١١١١١١", "card", "٤١١١١١١١١١١١١١١١"),
])
def test_disguised_spans(text, kind, want):
    added = [(s.kind, text[s.start:s.end]) for s in pii.find(text) if not s.base]
    assert added == [(kind, want)]
    assert base(text) == brute(text)


@pytest.mark.parametrize("blank", [c for c in map(chr, range(0x80, 0x3001)) if unicodedata.normalize("NFKC", c) == " "])
def test_groups_set_apart_by_forms_of_the_space(blank):
    """No-break, thin, figure and ideographic spaces count as plain ones, between plain and full-width digits."""
    for text, kind, want in [
            ("pay 4111 1111 1111 1111 now", "card", "4111 1111 1111 1111"), ("tel +49 170 1234567, ok", "phone", "+49 170 1234567"),
            ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
            ("four one one one one one one one one one one one one one one one or", "card",
             "four one one one one one one one one one one one one one one one")]:
        text, want = text.replace(" ", blank), want.replace(" ", blank)
        assert [(s.kind, text[s.start:s.end]) for s in pii.find(text) if not s.base] == [(kind, want)]
        assert base(text) == brute(text)


@pytest.mark.parametrize("text", [
    "look at this. dot by dot", "We met at noon and saw the dot at the end", "three four", "Größe und Länge – naïve café", "a (at) b", "",
    "jo@example.com is plain", "one two three go", "[at] (dot)",
])
def test_clean_texts_gain_nothing(text):
    assert all(s.base for s in pii.find(text))


def test_rewriting_keeps_track_of_the_source():
    rng = random.Random(7)
    for _ in range(2000):
        source = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 14)))
        mapped, want = pii.Mapped(source), [(c, i, i + 1) for i, c in enumerate(source)]
        for _ in range(3):
            edits, at = [], 0
            while at < len(mapped.text):
                lo = rng.randint(at, len(mapped.text))
                hi = lo + rng.randint(1, 3)
                if hi > len(mapped.text):
                    break
                edits.append((lo, hi, "".join(rng.choice("XY") for _ in range(rng.randint(0, 2)))))
                at = hi + rng.randint(0, 2)
            new, at = [], 0
            for lo, hi, put in edits:
                new += want[at:lo] + [(c, want[lo][1], want[hi - 1][2]) for c in put]
                at = hi
            want = new + want[at:]
            mapped = mapped.rewrite(edits)
            assert mapped.text == "".join(c for c, _, _ in want)
            assert all(mapped.source(a, b) == (want[a][1], want[b - 1][2])
                       for a in range(len(want)) for b in range(a + 1, len(want) + 1))


def test_edge_rows(edge_docs, no_docs, texts):
    out = pii.detect(edge_docs).select("doc_id", pii.written(pii.base_spans(F.col("spans"))).alias("s"))
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(
        ((i, ",".join(f"{k}:{a}:{b}" for k, a, b in brute(t))) for i, t in texts), key=str)
    assert pii.detect(no_docs).count() == 0


def test_long_texts_take_time_in_proportion():
    for piece in (" ", "a.", "one ", "@ ", "[ ", "+1 ", "1.", "x at ", "9", "a@", " dot a", "é–"):
        pii.find(piece * 40_000)
