"""Token-ID files (operator 10): flat unsigned integers plus 64-bit document offsets.

Documents are range-partitioned and sorted by id, each partition encodes its documents and writes

* ``<part>.ids``  all token ids, little-endian unsigned (16 bits if the vocabulary allows, else 32), nothing between
  documents;
* ``<part>.off``  little-endian unsigned 64-bit offsets into it, one per document plus the end;
* ``<part>.doc``  little-endian signed 64-bit document ids.

Part ``p`` starts at global position ``base[p]`` = ids in all parts before it: a prefix sum over one
row per part.  Files are read memory-mapped (ranged reads where the store can't be mapped).

Defined results: NULL text is empty and still gets its end id; NULL ids come first (``n_null`` in the
manifest counts them); repeated ids stay separate documents, ordered by a hash of their text; an empty
table gives no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from itertools import accumulate, chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import slices, table, text_bytes, worker_cache
from feedloom.session import arrow_uri, open_output, scratch_path

#: Word types and plain cores kept per worker before that cache starts anew.
CACHE_TYPES, CACHE_CORES = 700_000, 800_000
MANIFEST = "part int, path string, dtype string, n_docs long, n_null long, n_ids long"
#: Words of these letters are one token sequence whatever stands around them, case apart; so is a
#: run of these signs after them.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{}~]*)")


class WordEncoder:
    """Encodes white-space separated words with a ``tokenizers`` file and remembers their ids as bytes.

    White space never gets an id and no rule of the tokenizer looks across it, so a text's ids are its
    words' ids.  New plain words go to the library many at a time, joined by spaces; a word ends at the
    id whose piece carries the end-of-word mark.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        top = max(end_id, *vocab.values())
        self.dtype = id_dtype(top)
        self.end = np.array([end_id], self.dtype).tobytes()
        self.ends = np.zeros(top + 1, bool)
        self.ends[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        self.types: dict[bytes, bytes] = {}
        self.cores: dict[str, bytes] = {}

    def pack(self, ids) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def plain(self, words: list[str]) -> None:
        wide = np.dtype(self.dtype).itemsize
        parts = [words[i:i + 1000] for i in range(0, len(words), 1000)]
        for part, e in zip(parts, self.tok.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(e.ids, np.int64)
            cut = (np.flatnonzero(self.ends[ids]) + 1) * wide
            if len(cut) == len(part):
                data, at = self.pack(ids), 0
                for w, end in zip(part, cut.tolist()):
                    self.cores[w] = data[at:end]
                    at = end
            else:
                for w in part:
                    self.cores[w] = self.pack(self.tok.encode(w, add_special_tokens=False).ids)

    def learn(self, new: list[bytes]) -> None:
        split, odd, cores, known, match = [], [], {}, self.cores, PLAIN.fullmatch
        for w in new:
            if m := match(s := w.decode()):
                core, tail = m[1].lower(), m[2]
                split.append((w, core, tail))
                if core not in known:
                    cores[core] = None
                if tail and tail not in known:
                    known[tail] = self.pack(self.tok.encode(tail, add_special_tokens=False).ids)
            else:
                odd.append((w, s))
        self.plain(list(cores))
        for w, core, tail in split:
            self.types[w] = known[core] + known[tail] if tail else known[core]
        for (w, _), e in zip(odd, self.tok.encode_batch([s for _, s in odd], add_special_tokens=False)):
            self.types[w] = self.pack(e.ids)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids, with the end id, as ``dtype`` bytes."""
        words = [t.split() for t in texts]
        wanted = set(chain.from_iterable(words))
        wanted.difference_update(self.types)
        if len(self.types) + len(wanted) > CACHE_TYPES:
            self.types.clear()
            wanted = set(chain.from_iterable(words))
        if len(self.cores) > CACHE_CORES:
            self.cores.clear()
        self.learn(list(wanted))
        get = self.types.__getitem__
        return [b"".join(map(get, ws)) + self.end for ws in words]


def id_dtype(top: int) -> str:
    """Narrowest little-endian unsigned type that holds the ids up to ``top``."""
    return "<u2" if top < 1 << 16 else "<u4"


def write_files(df: DataFrame, out_dir: str, tokenizer_path: str, id_col: str = "doc_id",
                text_col: str = "text", end_id: int = 1) -> list:
    """Encode and write ``df``; returns the manifest, one row per part (path, documents, ids)."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = df.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("t"))
    src = src.withColumn("h", F.xxhash64("t"))

    def write(batches):
        import os
        import uuid
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import pandas as pd
        from pyspark import TaskContext
        cache = worker_cache("word_encoder")
        key = (tokenizer_path, end_id)
        if key not in cache:
            cache[key] = WordEncoder(*key)
        enc, part = cache[key], TaskContext.get().partitionId()
        wide = np.dtype(enc.dtype).itemsize
        path, files = f"{out_dir}/part-{part:05d}-{uuid.uuid4().hex[:8]}", None
        docs = nulls = ids = 0
        for pdf in batches:
            texts = pdf["t"].tolist()
            if files is None and texts:
                files = [open_output(path + x) for x in (".ids", ".off", ".doc")]
                files[1].write(np.zeros(1, "<u8").tobytes())
            for i, j in slices(texts):
                out = enc.encode(texts[i:j])
                offs = ids + np.cumsum([len(a) // wide for a in out])
                files[0].write(b"".join(out))
                files[1].write(offs.astype("<u8").tobytes())
                ids = int(offs[-1])
            null = pdf["id"].isna()
            nulls += int(null.sum())
            docs += len(texts)
            if texts:
                files[2].write(pdf["id"].fillna(0).to_numpy().astype("<i8").tobytes())
        if files:
            for f in files:
                f.close()
            yield pd.DataFrame([(part, path, enc.dtype, docs, nulls, ids)],
                               columns=["part", "path", "dtype", "n_docs", "n_null", "n_ids"])

    rows = (src.repartitionByRange(n, "id", "h").sortWithinPartitions("id", "h").select("id", "t")
            .mapInPandas(write, MANIFEST).collect())
    return sorted(rows, key=lambda r: r.part)


def mapped(path: str):
    """``read(dtype, start, stop)`` of a file: a memory map, or ranged reads from a remote store."""
    import pyarrow.fs as pafs
    if path.startswith("file:") or "://" not in path:
        local = "/" + path.removeprefix("file:").lstrip("/")
        return lambda dtype, a, b: np.memmap(local, dtype, "r")[a:b]
    fs, inner = pafs.FileSystem.from_uri(arrow_uri(path))
    f = fs.open_input_file(inner)

    def read(dtype, a, b):
        size = np.dtype(dtype).itemsize
        f.seek(a * size)
        return np.frombuffer(f.read((b - a) * size), dtype)
    return read


def read_files(spark: SparkSession, manifest: list, chunk_docs: int = 4096) -> DataFrame:
    """Documents as the files hold them: doc_id, start, n_tokens, ids_crc32."""
    out = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not manifest:
        return spark.createDataFrame([], out)
    base = [0, *accumulate(r.n_ids for r in manifest)]
    index = spark.createDataFrame([(*r, b) for r, b in zip(manifest, base)], MANIFEST + ", base long")

    def read(batches):
        import pandas as pd
        for pdf in batches:
            for r in pdf.itertuples():
                ids, off, doc = (mapped(r.path + x) for x in (".ids", ".off", ".doc"))
                for i in range(0, r.n_docs, chunk_docs):
                    j = min(i + chunk_docs, r.n_docs)
                    o = off("<u8", i, j + 1).astype(np.int64)
                    a = ids(r.dtype, int(o[0]), int(o[-1])).astype("<u4")
                    rel = (o - o[0]).tolist()
                    crc = [zlib.crc32(a[x:y].tobytes()) for x, y in zip(rel, rel[1:])]
                    d = pd.array(doc("<i8", i, j), "Int64")
                    d[np.arange(i, j) < r.n_null] = pd.NA
                    yield pd.DataFrame({"doc_id": d, "start": r.base + o[:-1], "n_tokens": np.diff(o), "ids_crc32": crc})

    return index.repartition(len(manifest)).mapInPandas(read, out)


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = write_files(docs, scratch_path(spark, "token-files"), public_tokenizers.path("word_bpe_49k.json"))
    return read_files(spark, manifest)
