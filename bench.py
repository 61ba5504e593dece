"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local cores.
Every query runs whole into a sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pairloom.functions.patterns import END_OF_TEXT
from pairloom.operators import counts, decode, encode, nexttoken, stream, windows
from pairloom.plans import catalog, generate, train
from pairloom.session import local_session, scratch_path
from pairloom.sources import artifacts

MERGES, MORE_MERGES = 100, 1000
SPECIALS = (END_OF_TEXT,)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, "pairloom-bench")
    times: dict[str, float] = {}
    extra: dict[str, float] = {}

    def timed(name, work):
        began = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - began, 3)
        return result

    docs = catalog.texts(spark, folder, "documents")
    vocab_size = 257 + MERGES

    timed("count_pretokens", lambda: run(counts.count_pretokens(docs, SPECIALS)))
    words = counts.count_pretokens(docs, SPECIALS).persist()
    extra["distinct_pretokens"] = words.count()
    trained = timed("train_bpe", lambda: train.train_bpe(words, vocab_size, SPECIALS))
    extra["merges"], extra["rounds"] = len(trained.merges), trained.rounds
    extra["sec_per_round"] = round(times["train_bpe"] / trained.rounds, 3)
    extra["merges_per_sec"] = round(len(trained.merges) / times["train_bpe"], 2)

    more = timed("train_bpe_1000", lambda: train.train_bpe(words, 257 + MORE_MERGES, SPECIALS))
    extra["merges_1000"], extra["rounds_1000"] = len(more.merges), more.rounds
    extra["sec_per_round_1000"] = round(times["train_bpe_1000"] / more.rounds, 3)

    tok = encode.Tokenizer(trained.vocab(), trained.merges_table(), SPECIALS)
    timed("encode_pretokens", lambda: run(encode.encode_pretokens(words, tok)))
    path = scratch_path(spark, "bench-encoded")
    timed("encode_documents", lambda: encode.encode_documents(docs, tok).write.parquet(path))
    ids = spark.read.parquet(path)
    tokens = timed("count_tokens", lambda: encode.count_tokens(ids).first()["n_tokens"])
    extra["tokens"] = tokens
    extra["encode_tokens_per_sec"] = round(tokens / times["encode_documents"])
    timed("encode_lines", lambda: run(encode.encode_lines(docs, tok)))
    timed("decode", lambda: run(decode.decode(ids, tok.vocab)))
    timed("roundtrip_audit", lambda: decode.roundtrip_audit(docs, tok).count())

    blocks_path = scratch_path(spark, "bench-blocks")
    timed("flatten_token_stream", lambda: artifacts.write_token_stream(stream.flatten_token_stream(ids), blocks_path))
    blocks = artifacts.open_token_stream(spark, blocks_path)
    timed("sample_windows", lambda: run(windows.sample_windows(blocks, 1024, 256, seed=1)))
    table = nexttoken.next_token_table(ids).persist()
    timed("next_token_table", table.count)
    timed("validate_held_out", lambda: run(nexttoken.validate_sequences(ids, table, vocab_size)))

    def generated():
        prompts = encode.encode_documents(
            catalog.texts(spark, folder, "benchmark"), tok, keys=("item_id",)
        ).withColumnRenamed("item_id", "prompt_id")
        run(generate.generate_batch(prompts, generate.sampler_table(table, 0.8, 0.9), 16, seed=1))

    timed("generate_batch", generated)
    for name in ("softmax", "cross_entropy", "top_p_filter", "top_p_sample", "rms_normalize"):
        timed(name, lambda: run(catalog.QUERIES[name](spark, folder)))

    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "details": extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
