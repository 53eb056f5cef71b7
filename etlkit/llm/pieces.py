"""The pieces of a public SentencePiece vocabulary file."""

from __future__ import annotations

from functools import lru_cache

SPACE = "▁"
_NORMAL = 1


@lru_cache(maxsize=2)
def read_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the ordinary pieces of a byte-fallback BPE model.

    Raises for models whose text treatment is another: only spaces are marked, one is put
    before the text, and nothing else is changed.
    """
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    model = model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    spec, trained = model.normalizer_spec, model.trainer_spec
    other = {p.type for p in model.pieces} - {_NORMAL, 2, 3, 6}  # unknown, control, byte
    if (other or trained.model_type != trained.BPE or not trained.byte_fallback or spec.precompiled_charsmap
            or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or trained.treat_whitespace_as_suffix):
        raise ValueError(f"{path}: not a plain byte-fallback BPE model")
    return [(p.piece, p.score) for p in model.pieces if p.type == _NORMAL]
