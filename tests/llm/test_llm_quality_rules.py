import random
import re
from collections import Counter

import cases
from hypothesis import given, settings
from hypothesis import strategies as st

from speechloom.llm import quality_rules as Q


def plain(text):
    """The measurements, counted one by one."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_letters": sum(c.isalpha() for c in text), "n_digits": sum(c in "0123456789" for c in text),
        "n_bullet_lines": sum(x.lstrip(" ")[:1] in tuple("-*•") for x in lines),
        "n_ellipsis_lines": sum(x.replace("\r", "").rstrip(" ").endswith(("...", "…")) for x in lines),
    }


def failures(m):
    return sum(1 << i for i, rule in enumerate(Q.RULES.values()) if eval(rule, {}, dict(m)))


def held(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in Q.ledger(docs).collect():
        wanted = plain(texts[r.doc_id])
        assert {k: r[k] for k in wanted} == wanted, texts[r.doc_id][:200]
        assert r.failed == failures(wanted)


def test_measurements_like_plain_counting(spark):
    rng = random.Random(3)
    texts = ["", None, " \t\n", "a", "a a", "a a a", "a a a a", "a b c a b c a b", "x\ny\nx\n \n \n", "- a\n* b...\n•c…\r\n-\n",
             "漢字 ñ😀 | <b> #1 100%", "a\x0bb\x0cc d e", "\x1ca\x00b"]
    for _ in range(60):
        n = rng.choice([5, 30, 400])
        texts.append("".join(rng.choice(["a", "b", "cc", "d1"]) + rng.choice([" ", " ", "\n", "  ", "\t"]) for _ in range(n)))
    texts.append(" ".join(f"w{rng.randrange(300)}" for _ in range(200_000)))
    texts.append("la " * 100_000)
    held(spark, texts)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("ab#-.\n\t 1é", max_size=60), min_size=1, max_size=30))
def test_any_texts(spark, texts):
    held(spark, texts)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    rows = Q.ledger(docs, "lang", "n").collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    assert {r.n for r in rows} == {"clash"}
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    assert sorted(r.n_words for r in rows) == sorted(n for (_, t), k in texts.items() for n in [plain(t)["n_words"]] * k)
    none = Q.ledger(cases.empty(spark))
    assert none.count() == 0 and Q.verdicts(none, "3").count() == 0
    assert Q.ablations(none, "3").count() == 0 and Q.changes(none, "1", "3").count() == 0


def test_policies_only_grow_and_cover_the_base():
    assert list(Q.POLICIES) == ["1", "2", "3"]
    assert Q.mask("1") & Q.mask("3") == Q.mask("1") and Q.mask("2") & ~Q.mask("3") == 0
    assert Q.mask(("few_words",)) == 1 and Q.mask(("repeated_words",)) == 2


def test_verdicts_ablations_and_changes(spark):
    rng = random.Random(4)
    bits = [rng.randrange(1 << len(Q.RULES)) if rng.random() < 0.7 else 0 for _ in range(500)]
    entries = spark.createDataFrame(list(enumerate(bits)), "doc_id bigint, failed bigint")
    for version, rules in Q.POLICIES.items():
        m = Q.mask(version)
        kept = {r.doc_id for r in Q.verdicts(entries, version).where("kept").collect()}
        assert kept == {i for i, b in enumerate(bits) if not b & m}
        table = {r.rule: r for r in Q.ablations(entries, version).collect()}
        assert set(table) == set(rules)
        for rule, r in table.items():
            bit = Q.mask((rule,))
            assert r.n_failed == sum(bool(b & bit) for b in bits)
            assert r.n_only == sum(b & m == bit for b in bits)
            assert r.n_kept == len(kept) and r.n_kept_without == sum(not b & (m & ~bit) for b in bits)
    moved = {r.doc_id: (r.kept_before, r.kept_after) for r in Q.changes(entries, "1", "3").collect()}
    assert moved == {i: (True, False) for i, b in enumerate(bits) if not b & Q.mask("1") and b & Q.mask("3")}


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    plan = Q.verdicts(Q.ledger(docs), "3")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
