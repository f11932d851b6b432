"""python tests/llm/measure_recall.py DIR: the near-copy join over DIR/documents.parquet against an exact join of its own.

The exact join shares nothing with the operator: words by a regular expression, shingles by BLAKE2, candidates by
prefix filtering (of two sets with similarity t, the rarest n - ceil(t * n) + 1 shingles of each share one), and every
candidate is counted in full. It prints how many links between different texts there are, and on how many documents
the operator's class and number of links differ.
"""

import os
import re
import sys
from collections import Counter, defaultdict
from hashlib import blake2b
from math import ceil
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

sys.path.insert(0, str(Path(__file__).parents[2]))
os.environ["PYTHONPATH"] = f"{Path(__file__).parents[2]}:{os.environ.get('PYTHONPATH', '')}"

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def exact_join(rows, similarity=0.8, words=5):
    """{row: (class, links)} and the number of links between different texts, for (doc_id, text) rows of unlike ids."""
    members, sets = defaultdict(list), []
    for doc_id, text in rows:
        w = WORD.findall((text or "").lower().encode("utf-8", "replace"))
        members[tuple(w) if w else ("alone", doc_id)].append(doc_id)
    groups = list(members.values())
    for key in members:
        if key[0] == "alone":
            sets.append(np.zeros(0, np.uint64))
            continue
        parts = [b" ".join(key[i : i + words]) for i in range(max(1, len(key) - words + 1))]
        sets.append(np.unique(np.array([int.from_bytes(blake2b(p, digest_size=8).digest(), "little") for p in parts], np.uint64)))
    _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    sets = [s[np.lexsort((s, count[s]))] for s in np.split(number, cuts)]  # rarest first
    sorted_sets = [np.sort(s) for s in sets]
    index = defaultdict(list)
    links, up = [0] * len(sets), list(range(len(sets)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    n_links = 0
    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        n = len(sets[i])
        seen = Counter()
        for s in sets[i][: n - ceil(similarity * n - 1e-9) + 1].tolist():
            for j in index[s]:
                if len(sets[j]) >= similarity * n - 1e-9:
                    seen[j] += 1
            index[s].append(i)
        for j in seen:
            both = len(np.intersect1d(sorted_sets[i], sorted_sets[j], assume_unique=True))
            if both >= similarity * (n + len(sets[j]) - both) - 1e-9:
                n_links += 1
                links[i] += len(groups[j])
                links[j] += len(groups[i])
                up[find(i)] = find(j)
    least = {}
    for i, g in enumerate(groups):
        least[find(i)] = min(least.get(find(i), min(g)), min(g))
    return {d: (least[find(i)], links[i] + len(g) - 1) for i, g in enumerate(groups) for d in g}, n_links


def main(folder):
    from pyspark.sql import SparkSession

    from gridledger.llm import neardup

    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    want, n = exact_join(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))
    print(f"{folder}: {len(want)} documents, {n} links between different texts", flush=True)
    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", "16").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    got = {r.doc_id: (r.class_id, r.n_links) for r in neardup.near_copies(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")).toLocalIterator()}
    other = [d for d in want if got.get(d) != want[d]]
    lost = sum(want[d][1] for d in want) - sum(got[d][1] for d in want if d in got)
    print(f"{folder}: {len(other)} documents with another class or number of links; {lost} of {sum(want[d][1] for d in want)} link ends missing; {other[:5]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    for name in sys.argv[1:]:
        main(name)
