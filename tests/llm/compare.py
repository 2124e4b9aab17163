"""Compare results of the registered queries over one folder with brute force (a script)."""
import sys

import duckdb
import os
import pyarrow.parquet as pq
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute


def main(sf, out):
    load = lambda n: pq.read_table(f"{out}/{n}").to_pylist()
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in load("op6_minhash_dedup")}
    want = brute.near_docs(docs, 85)
    print("op6", got == want, sum(got[i] != want[i] for i in want), sum(c != i for i, (_, c) in want.items()))
    want = brute.repeats(docs)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in load("op10_repeated_passages")}
    print("op10", got == want, sum(got[i] != want[i] for i in want), sum(v[1] > 0 for v in want.values()))
    vec = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{sf}/embeddings.parquet").to_pylist()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in load("op2_embedding_dedup")}
    want = brute.near_vectors(vec, 0.98)
    print("op2", got == want, sum(got[i] != want[i] for i in want), sum(v[0] > 0 for v in want.values()))
    bad = 0
    by = {r["doc_id"]: r for r in load("op9_secret_scan")}
    import hashlib
    n = 0
    for i, t in docs:
        s = brute.base_spans(t)
        n += len(s)
        bad += by[i]["base_sha256"] != hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in s).encode()).hexdigest()
    print("op9 bad", bad, "spans", n, "extra", sum(len([x for x in r["spans"].split(",") if x]) for r in by.values()) - n)
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    sys.path.insert(0, "/root/repo")
    from riffle.llm.queries import ORACLES
    for name, sql in ORACLES.items():
        cols = sorted(pq.read_table(f"{out}/{name}").column_names)
        a = sorted([tuple(r[k] for k in cols) for r in load(name)], key=str)
        b = sorted(c.execute(f"select {','.join(cols)} from ({sql})").fetchall(), key=str)
        print(name, len(a), len(b), a == b, next(((x, y) for x, y in zip(a, b) if x != y), ""))
    seq = {}
    for r in load("op1_best_fit_packing"):
        seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    ok = all(all(o == sum(l for _, l in sorted(p)[:k]) for k, (o, _) in enumerate(sorted(p))) and sum(l for _, l in p) <= 2048 for p in seq.values())
    total = sum(l for p in seq.values() for _, l in p)
    print("op1 ok", ok, "sequences", len(seq), "bound", -(-total // 2048))
    from tokenizers import Tokenizer
    import numpy as np, zlib
    from riffle.llm.queries import tokenizer_path
    tk = Tokenizer.from_file(tokenizer_path())
    rows = {(r["doc_id"], r["piece"]): r for r in load("op1_best_fit_packing")}
    bad = 0
    for (i, t), e in zip(docs, tk.encode_batch([t or "" for _, t in docs], add_special_tokens=False)):
        ids = e.ids + [0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            x = ids[at:at + 2048]
            r = rows.pop((i, n))
            bad += (r["start"], r["length"], r["ids_crc32"]) != (at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
    print("op1 ids bad", bad, "left", len(rows))
    sh = load("op5_virtual_slots")
    import collections
    b = collections.Counter(); sl = collections.defaultdict(list); tx = collections.defaultdict(set)
    for r in sh:
        b[r["shard"]] += r["size"]; sl[r["shard"]].append(r["slot"])
    print("op5", sorted(b.items()), all(sorted(x) == list(range(len(x))) for x in sl.values()), len(sh))
    lab = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    for h in (True, False):
        conf = collections.Counter((lab[r["doc_id"]], r["predicted"]) for r in load("op8_toxicity") if r["doc_id"] in lab and r["held_out"] == h)
        print("op8 held out" if h else "op8 train", dict(conf))


if __name__ == "__main__":
    main(*sys.argv[1:])
