"""Personal data: base spans by definition, added spans by planted disguises."""
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import pii
from feedloom.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"
KINDS = list(pii.KINDS)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@-_ +()0129é\n٣", max_size=60))
def test_detect_is_the_definition(text):
    assert sorted((KINDS[k], s, e) for k, s, e in pii.detect(text)) == sorted(brute.pii(text))


def test_query_matches_definition(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_pii"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute.pii(docs[r.doc_id])
        assert r.base_sha256 == brute.sha(brute.joined(want, KINDS))
        assert [r[f"n_{k}"] for k in KINDS] == [sum(w[0] == k for w in want) for k in KINDS]
        assert len(r.spans.split(",")) * bool(r.spans) == len(want) + r.n_added


def test_disguises_map_back_to_source():
    cases = {
        "mail me: jane.doe [at] example [dot] com today": ("email", "jane.doe [at] example [dot] com"),
        "jane dot doe at example dot co dot uk, thanks": ("email", "jane dot doe at example dot co dot uk"),
        "write jane(at)example.org now": ("email", "jane(at)example.org"),
        "x jаne@exаmple.cоm y": ("email", "jаne@exаmple.cоm"),
        "ab​c@exa​mple.com": ("email", "ab​c@exa​mple.com"),
        "call plus one four one five five five five two six seven one ok": ("phone", "plus one four one five five five five two six seven one"),
        "tel +１ ４１５ ５５５ ２６７１.": ("phone", "+１ ４１５ ５５５ ２６７１"),
        "host １９２.168.0.1 up": ("ip", "１９２.168.0.1"),
        "card 4111 1111 1111 ١١١١ end": ("card", "4111 1111 1111 ١١١١"),
    }
    for text, (kind, part) in cases.items():
        s = text.index(part)
        assert (KINDS.index(kind), s, s + len(part)) in pii.added(text, pii.detect(text)), text
    for text in ("meet me at the shop. Then dot the i", "one two three and four", "рыба и хлеб", "at home. dot"):
        assert pii.added(text, pii.detect(text)) == []


def test_disguise_in_a_part_of_what_the_base_finds():
    cases = {
        "x jаne@example.com y": ("email", "jаne@example.com", "ne@example.com"),
        "ask jane dot doe@example.com now": ("email", "jane dot doe@example.com", "doe@example.com"),
        "x ja\u200bne@example.com y": ("email", "ja\u200bne@example.com", "ne@example.com"),
        "tel +1 415 555 267１ now": ("phone", "+1 415 555 267１", "+1 415 555 267"),
    }
    for text, (kind, part, tail) in cases.items():
        k, s, t = KINDS.index(kind), text.index(part), text.index(tail)
        base = pii.detect(text)
        assert base == [(k, t, t + len(tail))], text
        assert pii.added(text, base) == [(k, s, s + len(part))], text
    # What a base span covers is not added again, also beside a disguise elsewhere.
    for text in ("jane@example.com and ‐", "1.2.3.4 for one two", "+1 415 555 2671 has one 2 three"):
        assert pii.added(text, pii.detect(text)) == [], text


def test_partly_spelled_numbers():
    cases = {
        "call +1 415 five five five 2671 now": ("phone", "+1 415 five five five 2671"),
        "call plus 44 two zero seven nine four six zero nine five eight ok": ("phone", "plus 44 two zero seven nine four six zero nine five eight"),
        "host 192 dot 168 dot zero dot one up": ("ip", "192 dot 168 dot zero dot one"),
        "host one nine two dot one six eight dot zero dot one up": ("ip", "one nine two dot one six eight dot zero dot one"),
        "card 4111 1111 1111 one one one one end": ("card", "4111 1111 1111 one one one one"),
        "in 2019 four one five five five five two six seven one": ("phone", "four one five five five five two six seven one"),
    }
    for text, (kind, part) in cases.items():
        s = text.index(part)
        assert (KINDS.index(kind), s, s + len(part)) in pii.added(text, pii.detect(text)), text
    for text in ("One. Two. Three. Four.", "one, two, three, four", "one 2 three of 2019, four", "version one dot two"):
        assert pii.added(text, pii.detect(text)) == [], text


def test_odd_rows(spark):
    long = "a" * 200_000 + "@" + "1" * 200_000 + " " + "+1(" * 50_000 + " one" * 40_000
    rows = [(1, None), (2, ""), (None, "a@b.co"), (3, long), (3, "1.2.3.4"), (3, "1.2.3.4")]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, n long, spans string")
    got = pii.find(df).collect()
    assert len(got) == len(rows) and sum(r.n_ip for r in got) == 2 and sum(r.n_email for r in got) == 1
    assert pii.find(df.limit(0)).count() == 0


def test_rewrites_compose():
    rng = random.Random(1)
    tape = pii.Tape("0123456789")
    tape.rewrite([(2, 5, "x"), (7, 8, "")])
    tape.rewrite([(1, 4, "YZ")])
    assert tape.text == "0YZ689" and (tape.start[1], tape.end[2]) == (1, 6) and rng


def test_digits_spelled_in_four_languages():
    from feedloom.llm.pii import added, detect
    cases = {
        "ruf an plus vier neun drei null fünf sechs sieben acht eins zwei drei bitte": ("phone", "plus vier neun drei null fünf sechs sieben acht eins zwei drei"),
        "appelez le plus trois trois un quatre deux six huit neuf cinq zéro sept ok": ("phone", "plus trois trois un quatre deux six huit neuf cinq zéro sept"),
        "llama al +34 nueve uno dos tres cuatro cinco seis siete ocho hoy": ("phone", "+34 nueve uno dos tres cuatro cinco seis siete ocho"),
        "server uno cero punto 20 punto tres punto 4 hoy": ("ip", "uno cero punto 20 punto tres punto 4"),
    }
    kinds = ("email", "ip", "card", "phone")
    for text, (kind, span) in cases.items():
        got = [(kinds[k], text[a:b]) for k, a, b in added(text, detect(text))]
        assert (kind, span) in got, (text, got)
    for clean in ("null, null, null, null, null, null, null, null, null, null, null, null, null", "un deux trois soleil", "acht neun zehn",
                  "uno dos tres, cuatro casas", "sept huit neuf personnes et six autres"):
        assert added(clean, detect(clean)) == []
