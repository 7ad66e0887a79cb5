"""Word rules against plain Python, line frequencies on a small fixture, odd inputs."""

import re
from collections import Counter

from corpus_rows import docs, no_docs, odd_docs, rows  # noqa: F401

from snapmerge.llm import line_rules, simhash


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    c = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if c[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed


def test_counts_match(docs):
    got = line_rules.judge(docs, with_text=True).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(r.text), r.doc_id
        assert not (r.base_failed and r.kept)


def test_common_lines_go_and_depleted_documents_too(spark):
    def body(i, n):
        return " ".join(f"word{i}x{k}" for k in range(n))
    notice = "Subscribe to our Newsletter   since 2001 and never miss a single story again"
    rows = [(i, f"{body(i, 30)}\n{notice}", "busy") for i in range(12)]
    rows += [(20 + i, f"{body(20 + i, 11)}\n{notice.upper().replace('2001', '1987')}\n{notice}", "busy") for i in range(3)]
    rows += [(40 + i, f"{body(40 + i, 30)}\n{notice}", "quiet") for i in range(3)]
    rows += [(60 + i, f"{body(60, 30)}\nan exact copy on every row", "busy") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in line_rules.judge(docs).collect()}
    assert all(got[i].kept and got[i].removed_words == 13 for i in range(12))
    assert all(not got[20 + i].kept and not got[20 + i].base_failed for i in range(3))  # 26 of 37 words are the notice
    assert all(got[i].kept and not got[i].removed_words for i in [*range(40, 43), *range(60, 90)])
    cleaned = {r.doc_id: r.text for r in line_rules.clean(docs).collect()}
    assert cleaned[0] == body(0, 30) and notice in cleaned[40] and 20 not in cleaned


def test_odd_inputs(odd_docs, no_docs):
    kept = line_rules.clean(odd_docs)
    assert kept.columns == odd_docs.columns
    want = {(r.doc_id, r.text) for r in odd_docs.collect() if not plain(r.text)[-1]}
    assert {(r.doc_id, r.text) for r in kept.collect()} == want
    assert line_rules.judge(no_docs).count() == 0 and line_rules.clean(no_docs).count() == 0


def test_edited_copies_that_fill_a_source_stay_for_the_next_stage(spark):
    def line(tag):
        return " ".join(f"{tag}y{chr(97 + k)}" for k in range(12))

    def letters(i):
        return "".join(chr(97 + int(c)) for c in str(i))
    page = [line(f"page{letters(j)}") for j in range(20)]
    notice = line("notice")
    rows = [(i, "\n".join([*page[:i % 20], line(f"edit{letters(i)}"), *page[i % 20 + 1:]]), "full") for i in range(300)]
    rows += [(1000 + i, r[1], "mixed") for i, r in enumerate(rows[:100])]
    rows += [(2000 + i, f"{line('own' + letters(i))}\n{line('more' + letters(i))}\n{notice}", "mixed") for i in range(60)]
    rows += [(3000 + i, f"{line('few' + letters(i))}\n{notice}\n{notice} {notice}\n{notice} {notice}", "mixed") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in line_rules.clean(docs).collect()}
    assert all(got[i] == text for i, text, _ in rows[:400])
    assert all(notice not in got[i] for i in range(2000, 2060))
    left = {r.doc_id for r in simhash.keep_one(docs.where("source = 'full'").transform(line_rules.clean)).collect()}
    assert 0 in left and len(left) < 300
    exact = line_rules.judge(docs).where("source = 'full' AND kept").count()  # by the SQL of op6_line_rules each text votes
    assert exact == 0
