"""The pipeline against its stages in plain Python, and the registered names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np

import __spark_entry__
import corpus_pipeline
from gridledger.llm import language, mixing
from gridledger.llm.encoder import default_vocabulary


def test_names():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_copies", "mixing", "packing"]


def test_pipeline(spark, documents, tmp_path):
    """Language decisions are the network's own; all that follows is worked out again here."""
    from tokenizers import Tokenizer

    rng = random.Random(12)
    words = {"en": ["the", "ing", "when", "lyer"], "pt": ["ção", "nhos", "lhe", "são"]}
    docs = []
    for i in range(160):
        lang = rng.choice(list(words))
        docs.append((i, " ".join(rng.choice(words[lang]) + str(rng.randrange(999)) for _ in range(rng.randrange(20, 90))), lang, rng.choice(["a", "b", None])))
    docs += [(200 + i, docs[i][1], docs[i][2], "b") for i in range(20)]  # exact copies
    docs += [(300 + i, docs[40 + i][1].replace(" ", "  ") + " end", docs[40 + i][2], "a") for i in range(20)]  # near copies, mostly
    docs += [(400, None, "en", "a"), (401, "12 34", "en", "a"), (402, "", "en", "a")]
    df = documents(docs)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = {r.doc_id for r in language.accepted(df).collect()}
    assert not kept & {400, 401, 402} and len(kept) > 190
    by_text = {}
    for d, t, _, s in docs:
        if d in kept:
            by_text[t] = max(by_text.get(t, -1), d)
    left = sorted(by_text.values())
    from test_texts import plain_links

    text, source = {d[0]: d[1] for d in docs}, {d[0]: d[3] for d in docs}
    classes = plain_links([(d, text[d]) for d in left])
    left = sorted({c for c, _ in classes.values()})
    assert len(left) < len(by_text)

    streams = {}
    for d in left:
        streams.setdefault(source[d], []).append(d)
    order = sorted(streams, key=lambda s: (s is None, s or ""))
    size = {d: len(text[d].split()) for d in left}
    goals = mixing.targets([sum(size[d] for d in streams[s]) for s in order], [3, 1, 2][: len(order)])
    tokenizer = Tokenizer.from_file(default_vocabulary())
    want = Counter()
    for s, goal in zip(order, goals):
        turns, rest = divmod(int(goal), sum(size[d] for d in streams[s]))
        for d in sorted(streams[s], key=lambda d: hashlib.md5(f"mix:{d}".encode()).hexdigest()):
            for n in [size[d]] * turns + [min(size[d], rest)]:
                if n:
                    t = text[d] if n == size[d] else " ".join(text[d].split()[:n])
                    ids = np.append(np.asarray(tokenizer.encode(t, add_special_tokens=False).ids), 1).astype("<u4")
                    want[d, len(ids), zlib.crc32(ids[:512].tobytes())] += 1
            rest -= min(size[d], rest)
    assert Counter((r.doc_id, r.doc_tokens, r.ids_crc32) for r in out if r.start == 0) == want
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append(r)
    for part in by.values():
        at = 0
        for r in sorted(part, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
