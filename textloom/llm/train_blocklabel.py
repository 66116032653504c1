"""Fit the block labeller: python -m textloom.llm.train_blocklabel DATA_DIR [OUT.npz]

Reads at most TRAIN_ROWS texts of DATA_DIR's blocks and chunks tables: all that
hold signs of markup, and a third as many that hold none.
"""

from __future__ import annotations

import random
import sys

import numpy as np
import pyarrow.dataset as ds

from .blocklabel import TRAIN_ROWS, WEIGHTS, train
from .markup_rules import leaves, teach


def main(data_dir: str, out: str = WEIGHTS) -> None:
    docs = []
    for name in ("blocks", "chunks"):
        for batch in ds.dataset(f"{data_dir}/{name}.parquet").to_batches(columns=["text"]):
            docs += [leaves(t, 3 if name == "chunks" else 0) for t in batch["text"].to_pylist() if t]
    rng = random.Random(3)
    rng.shuffle(docs)
    marked = [d for d in docs if any(map(teach, d))][:TRAIN_ROWS * 3 // 4]
    clean = [d for d in docs if not any(map(teach, d))][:len(marked) // 3]
    sample = marked + clean
    rng.shuffle(sample)
    model = train(sample, epochs=16, say=print)
    np.savez_compressed(out, **{k: v.astype("float16") for k, v in model.p.items()})


if __name__ == "__main__":
    main(*sys.argv[1:])
