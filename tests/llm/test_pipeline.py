"""The pipeline's stages on a small corpus, each against its own rule, and the registered queries."""

import duckdb
import pytest
from corpus_rows import hit_table, kept_bytes, rows  # noqa: F401
from test_line_rules import plain
from test_simhash import plain_components, plain_fingerprint

import __spark_entry__ as entry
import corpus_pipeline
from snapmerge.llm import packing, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, rows):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(*r, "en", len(r[1] or "")) for r in rows], "doc_id long, text string, source string, lang string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    item = dict((r[0], r[1]) for r in rows if r[0] is not None)[30]
    spark.createDataFrame([(1, " ".join(item.split()[:40]))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert 4 <= len(steps) <= 5

    ruled = steps["quality_rules"](spark, docs, folder).cache()
    assert ruled.columns == names
    assert sorted(str(r.doc_id) for r in ruled.collect()) == sorted(str(r.doc_id) for r in docs.collect() if not plain(r.text)[-1])

    single = steps["near_duplicates"](spark, ruled, folder).cache()
    raw = [(r.doc_id, r.text) for r in ruled.collect()]
    roots = plain_components([i for i, _ in raw], [plain_fingerprint(t) for _, t in raw], 4)
    assert single.columns == names
    assert sorted({str(r.doc_id) for r in single.collect()}) == sorted({str(i) for (i, _), c in zip(raw, roots) if i is None or i == c})

    cut = steps["repeated_passages"](spark, single, folder).cache()
    assert cut.columns == names and cut.count() == single.count()
    left = kept_bytes([r.text for r in single.collect()], corpus_pipeline.PASSAGE_BYTES, corpus_pipeline.PASSAGE_WORDS)
    assert any(gone for _, gone, *_ in left)
    assert sorted(k.decode() for *_, k in left) == sorted(r.text for r in cut.collect())
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    clean = steps["decontamination"](spark, cut, folder).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    bad = {i for i, *_, c in hit_table([(r.doc_id, r.text) for r in cut.collect()], items) if c}
    assert bad and clean.columns == names
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in cut.collect()} - bad

    packed = steps["packing"](spark, clean, folder).collect()
    whole = packing.pieces(clean.select("doc_id", "text"), queries.tokenizer_path()).select("doc_id", "piece", "ids").collect()
    assert sorted((str(r.doc_id), r.piece, r.ids) for r in packed) == sorted((str(r.doc_id), r.piece, r.ids) for r in whole)
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted((str(r.doc_id), r.piece, r.ids) for r in again) == sorted((str(r.doc_id), r.piece, r.ids) for r in whole)


def test_registered():
    names = set(queries.QUERIES)
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} and len(names) == 13
    assert names | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= names


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    want = con.sql(queries.ORACLE[key]).to_arrow_table().to_pylist()
    got = [r.asDict() for r in queries.QUERIES[key](spark, SMALL).collect()]
    assert sorted(map(str, (sorted(r.items()) for r in got))) == sorted(map(str, (sorted(r.items()) for r in want)))


#: contract columns and types of the registered queries (more may follow), and the table whose rows they answer one by one
COLUMNS = {
    "op1": ("documents", "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"),
    "op2": ("documents", "doc_id bigint, fingerprint string, component_id bigint"),
    "op3": ("documents", "doc_id bigint, held_out boolean, score double, predicted int"),
    "op4": ("documents", "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"),
    "op5": ("documents", "doc_id bigint, held_out boolean, score double, predicted int"),
    "op6": ("documents", "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
                         "base_failed boolean, kept boolean"),
    "op7": (None, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"),
    "op8": ("pages", "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"),
    "op9": ("documents", "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int"),
    "op10": ("pages", "page_id bigint, url string, text string, n_chars bigint"),
    "op11": ("embeddings", "vec_id bigint, n_links bigint, component_id bigint, kept boolean"),
    "op12": (None, "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"),
    "op13": ("embeddings", "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"),
}


@pytest.fixture(scope="module")
def answers(spark):
    return {k.split("_")[0]: q(spark, SMALL) for k, q in queries.QUERIES.items()}


@pytest.mark.parametrize("op", sorted(COLUMNS))
def test_contract_columns(spark, answers, op):
    table, columns = COLUMNS[op]
    names = columns.replace(",", "").split()[::2]
    assert ", ".join(f"{c} {dict(answers[op].dtypes)[c]}" for c in names) == columns
    if table:
        key = names[0]
        rows = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect())
        assert sorted(r[0] for r in answers[op].select(key).collect()) == rows


def test_registered_answers(spark, answers):
    """The registered queries against their contracts, rule by rule, on whole tables."""
    import base64
    import hashlib
    import zlib

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ids = sorted(docs)
    got = {op: {r[0]: r for r in answers[op].collect()} for op, (table, _) in COLUMNS.items() if table}
    prints = [plain_fingerprint(docs[i]) for i in ids]
    roots = plain_components(ids, prints, 4)
    assert [(got["op2"][i].fingerprint, got["op2"][i].component_id) for i in ids] == [(f"{f:016x}", c) for f, c in zip(prints, roots)]
    for op, parts, part, limit in (("op3", 4, 2, 0.3), ("op5", 3, 1, 0.5)):
        for i, r in got[op].items():
            assert r.held_out == (zlib.crc32(str(i).encode()) % parts == part) and 0 <= r.score <= 1 and r.predicted == int(r.score >= limit)
    want = kept_bytes([docs[i] for i in ids])
    assert [tuple(got["op4"][i])[1:5] for i in ids] == [(n, gone, spans, hashlib.sha256(kept).hexdigest()) for n, gone, spans, kept in want]
    pieces = {}
    for r in answers["op7"].collect():
        pieces.setdefault(r.sequence_id, []).append(r)
    tokens = queries.packing.WordCache(queries.tokenizer_path())
    for held in pieces.values():
        held.sort(key=lambda r: r.offset)
        assert [r.offset for r in held] == [sum(x.length for x in held[:k]) for k in range(len(held))] and sum(r.length for r in held) <= 2048
        for r in held:
            whole = tokens.tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids + [0]
            part = whole[r.start:r.start + 2048]
            assert r.start == 2048 * r.piece and r.length == len(part)
            assert r.ids_crc32 == zlib.crc32(b"".join(t.to_bytes(4, "little") for t in part))
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    last = {}
    for i in sorted(pages):
        last[pages[i]] = i
    for i, raw in pages.items():
        r = got["op8"][i]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if last[raw] == i else ("revisit", last[raw]))
        assert got["op10"][i].n_chars == len(got["op10"][i].text)
    shards = {}
    for i, r in got["op9"].items():
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(docs[i].encode()) + 1, zlib.crc32(docs[i].encode()), "bytes", None)
        shards.setdefault(r.shard, []).append(r.slot)
    assert set(shards) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in shards.values())
