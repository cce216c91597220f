"""Personal data against plain regular expressions, the filter audit against plain loops."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import pytest

from tests.llm.conftest import ODD
from tidelog.llm import filteraudit, pii

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def luhn(text):
    return sum(d if i % 2 == 0 else (2 * d) % 10 + 2 * d // 10 for i, d in enumerate(digits(text)[::-1])) % 10 == 0


def plainly(text):
    checks = {
        "email": (EMAIL, lambda m: True),
        "ip": (IP, lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (CARD, lambda m: 16 <= len(digits(m)) <= 19 and luhn(m)),
        "phone": (PHONE, lambda m: 8 <= len(digits(m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in checks.items() for m in re.finditer(p, text or "") if ok(m[0])]


def base(spans):
    return [s for s in spans if s[0] in pii.BASE_KINDS]


CASES = [
    "a@b.com@c.org", "a@b@c.com", "@b.com x@y x@y. x@y.z.", "é.a@ü.com a%b+c@d-e.f-g", "a@b.c" * 40, "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.256",
    "0000255.1.1.0000001", "1..2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111 1111 1111", "41111111111111111111",
    "+1 (743) 555-3824.", "+1", "+12", "+1-", "+1- 2", "++1 2345678", "+1 234567+8 9012345", "+1" + " " * 50 + "2345678", "+1 2345678901234567",
    "🙂 漢 x@y.zz 🙂+49 30 1234567🙂 10.0.0.1", "", None, "9" * 5000, "1." * 3000, "x" * 70_000 + "@y.z", "\x00a@b.c\x00",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_are_those_of_the_patterns(text):
    assert base(pii.personal_spans(text)) == plainly(text)


def test_base_spans_of_random_texts():
    rng = random.Random(12)
    for _ in range(4000):
        text = "".join(rng.choice("aZ0145 .-+@()é:/_") for _ in range(rng.randrange(60)))
        assert base(pii.personal_spans(text)) == plainly(text), text
    for _ in range(4000):
        text = "".join(rng.choice(["4111111111111111", " ", "-", "1", "0", ".", "255", "+", "@", "a.b", "é"]) for _ in range(rng.randrange(30)))
        assert base(pii.personal_spans(text)) == plainly(text), text


def test_addresses_and_accounts():
    def kinds(text):
        return [(k, text[a:b]) for k, a, b in pii.personal_spans(text)]

    assert kinds("see https://user:pw@host.example/x") == [("email", "pw@host.example"), ("address", "https://user:pw@host.example")]
    assert kinds("https://www.example.org/licenses/LICENSE-2.0 http://a:b/ ftp://@x") == []
    assert ("address", "mailto:a.b@c.de") in kinds("mailto:a.b@c.de, mailto:a@b")
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00.") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert kinds("IBAN DE88370400440532013000") == []
    assert kinds("Account number: 12-345-678, account 12345, ssn=078-05-1120, accounts 1234567") == [("account", "12-345-678"), ("account", "078-05-1120")]


def test_masked_documents_keep_their_columns(spark, odd, empty, build):
    docs = build([(1, "mail a@b.cc or https://u:a@b.cc now"), (2, None), (3, "clean")])
    out = pii.masked_documents(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "mail [email] or [address] now", 2: None, 3: "clean"}
    assert pii.masked_documents(empty).count() == 0 and pii.masked_documents(odd).count() == len(ODD)


def test_digests_of_odd_documents(odd, empty):
    got = pii.span_digests(pii.find_personal_data(odd)).collect()
    assert len(got) == len(ODD) and sum(r.doc_id is None for r in got) == 2
    assert {(r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans) for r in got} == {(0, 0, 0, 0, "")}
    assert {r.base_sha256 for r in got} == {hashlib.sha256(b"").hexdigest()}
    assert pii.span_digests(pii.find_personal_data(empty)).count() == 0


def failures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text))]


def audit(rows, labels):
    """Every order applied to every document."""
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    docs = []
    for doc_id, text, lang in rows:
        repeat = doc_id is not None and doc_id > least[text or ""]
        fails = {x for x, bad in zip("ABCDE", [*failures(text or ""), repeat], strict=True) if bad}
        known = [l for l in labels if doc_id is not None and l[0] == doc_id]
        docs.append((lang or "", fails, any(l[1] == 1 for l in known), any(l[2] == 1 for l in known)))
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for part in {d[0] for d in docs}:
            left = [d for d in docs if d[0] == part]
            everything = left
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                failing = [d for d in everything if letter in d[1]]
                shapley[part, letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(d[1] == {letter} for d in everything),
                    sum(d[2] for d in gone), sum(d[3] for d in gone),
                ]
    return {(*key, *figures, shapley[key[0], key[1][key[2] - 1]]) for key, figures in out.items()}


def test_audit_against_every_order_applied(spark, build):
    rng = random.Random(13)
    texts = [" ".join(rng.choice(["a", "b", "Cc", "DDD", "e#", *(f"w{i}" for i in range(300))]) for _ in range(rng.choice([3, 99, 100, 130]))) for _ in range(40)]
    rows = [*ODD, *((100 + i, rng.choice(texts)) for i in range(120)), (50, texts[0]), (105, texts[1]), (105, texts[1])]
    docs = build(rows)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in [7, 8, *range(90, 200)]] + [(101, 1, 1), (101, 0, 0), (None, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r) for r in filteraudit.filter_audit(docs, table).collect()}
    langs = [r.lang for r in docs.select("lang").collect()]
    assert got == audit([(*row, lang) for row, lang in zip(rows, langs, strict=True)], labels)


def test_audit_of_an_empty_table_and_without_labels(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.filter_audit(empty, none).count() == 0
    assert {r.good_lost for r in filteraudit.filter_audit(odd, none).collect()} == {0}


def test_sketch_clears_most_unique_texts_and_no_repeat(spark):
    docs = spark.createDataFrame([(i, f"text {i if i % 10 else 0}") for i in range(5000)], "doc_id long, text string")
    got = filteraudit.possible_repeats(docs).collect()
    assert all(r.repeat for r in got if r.doc_id % 10 == 0)
    assert sum(r.repeat for r in got if r.doc_id % 10) < 0.1 * 4500
    cells = [filteraudit.cells_for(n) for n in (0, 1, 10_000, 10**12)]
    assert cells == sorted(cells) and cells[0] == filteraudit.BITMAP_BITS and cells[-1] == filteraudit.MOST_CELLS
