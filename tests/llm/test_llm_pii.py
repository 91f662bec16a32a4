import random

import pytest
from brute import ODD_TEXTS, base_spans, documents, empty, sha

from arrivalmart.llm import pii


def listed(text):
    return [f"{k}:{a}:{b}" for a, b, k, _ in pii.find_spans(text) if k in pii.BASE]


def test_base_spans_equal_the_plain_expressions():
    draw = random.Random(8)
    signs = ["a", "B", ".", "-", "+", "@", "@", "1", "25", "255", "256", "0", " ", "(", ")", "_", "%", "é", "x.co", "4111111111111111", "+14895550950", "10.1.2.3"]
    for _ in range(20_000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(1, 25)))
        assert listed(text) == base_spans(text), repr(text)


def test_long_runs_take_linear_time():
    assert listed("a" * 300_000 + " @ " + "1" * 4000 + "." + "a@b" * 1000) == []


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("iban DE89 3704 0044 0532 0130 00.", ["iban"]),
        ("DE89370400440532013001", []),
        ("GB82WEST12345698765432", ["iban"]),
        ("her ssn is 123-45-6789", ["ssn"]),
        ("part 123-45-6789", []),
        ("ssn 000-45-6789", []),
        ("pay 4111-1111-1111-1111 now", ["card"]),
        ("pay 4111-1111-1111-1112 now", []),
    ],
)
def test_checksums_and_context(text, kinds):
    assert [k for _, _, k, _ in pii.find_spans(text)] == kinds


IBANS = ("BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "PL61 1090 1014 0000 0712 1981 2874", "DE89 3704 0044 0532 0130 00")


@pytest.mark.parametrize("after", [" BIC: CAIXESBB", " BIC", " 12", " 2024", " ABCD", " BANK AG", " CAIXESBBXXX", "", ", x", " and", "\n1234"])
@pytest.mark.parametrize("iban", [*IBANS, *[i.replace(" ", "") for i in IBANS]])
def test_account_numbers_end_before_what_follows(iban, after):
    text = f"pay {iban}{after}"
    assert [text[a:b] for a, b, k, _ in pii.find_spans(text) if k == "iban"] == [iban]
    assert pii.redact(text, [s for s in pii.find_spans(text) if s[2] == "iban"]) == f"pay <IBAN>{after}"


def test_account_numbers_in_a_row_and_after_a_false_start():
    text = f"AB13 3456 7890 {' '.join(IBANS)}"
    assert [text[a:b] for a, b, k, _ in pii.find_spans(text) if k == "iban"] == list(IBANS)
    assert [k for *_, k, _ in pii.find_spans("ES91 2100 0418 4502 0005 1333 BIC")] == []


def test_context_raises_the_score():
    plain, near = (pii.find_spans(t)[0][3] for t in ("see 10.1.2.3 there", "server 10.1.2.3 there"))
    assert near > plain


def test_rows_of_every_kind(spark):
    docs = documents(spark)
    expected = sorted(((r.doc_id, *[sum(s.startswith(k) for s in base_spans(r.text)) for k in pii.BASE], sha(",".join(base_spans(r.text)))) for r in docs.collect()), key=str)
    found = pii.digest(docs)
    got = sorted((tuple(r)[:6] for r in found.collect()), key=str)
    assert got == expected
    spans = {r.doc_id: r.spans for r in pii.scan(docs).where("doc_id = 11").collect()}
    assert {s.found for s in spans[11]} == {"Ann.Lee+x@mail.example.com", "+1 (489) 555-0950", "10.0.0.1"}
    assert pii.digest(empty(spark)).count() == 0 == pii.redacted(empty(spark)).count()


def test_redaction_keeps_all_else(spark):
    docs = documents(spark)
    left = pii.redacted(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    texts = {r.doc_id: r.text for r in left.collect() if r.doc_id is not None}
    assert texts[11] == "Größe ÉTÉ naïve 日本語 😀 mail me: <EMAIL> or <PHONE>, from <IP> not 10.0.0.256"
    assert texts[12] == "card <CARD> and 4111 1111 1111 1112, iban <IBAN>, ssn <SSN>"
    assert all(texts[k] == t for k, t in enumerate(ODD_TEXTS) if k not in (11, 12))
