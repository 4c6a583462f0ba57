"""The pipeline at sf0.001: each stage against its brute-force version on its own input."""

import sys
from pathlib import Path

from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from recsmith.llm import pretokens, toxicity  # noqa: E402
from recsmith.llm.common import stored, table  # noqa: E402

from . import brute  # noqa: E402
from .test_texts import check_pieces  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.collect()
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), name)
        rows = out.collect()
        ids = sorted(r.doc_id for r in rows) if name != "packing" else []
        if name == "toxicity":
            model = toxicity.train(docs, table(spark, SF, "labels"))
            want = [r.doc_id for r in toxicity.score(docs, model).collect() if r.predicted == 0]
        elif name == "exact_dedup":
            want = list({brute.lower(r.text): r.doc_id for r in sorted(before, key=lambda r: r.doc_id)}.values())
        elif name == "ngram_join":
            want = [d for d, n, c in brute.near_components([(r.doc_id, r.text) for r in before]) if not n or d == c]
        elif name == "decontamination":
            found = brute.windows(items)
            want = [r.doc_id for r in before if not brute.contamination(r.text, found)[1]]
        else:
            tok = Tokenizer.from_file(pretokens.default_path("byte_bpe_50k.json"))
            check_pieces(rows, [(r.doc_id, tok.encode(r.text, add_special_tokens=False).ids + [0]) for r in before])
            break
        assert out.columns == columns and ids == sorted(want)
        assert {tuple(r) for r in rows} <= {tuple(r) for r in before}
        docs, before = out, rows
