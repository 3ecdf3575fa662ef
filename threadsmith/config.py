"""Frozen configuration shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Fixed values that must equal the behaviour being reproduced:
# sentence delimiters of the original (CJK punctuation, a literal '|', newline),
# the trailing characters a topic sentence loses, placeholders, thresholds.
CJK_DELIMITERS = "。！？；，|\n"
CJK_TOPIC_TRIM = "，。！？；"
ASCII_DELIMITERS = ".!?;,\n"
ASCII_TOPIC_TRIM = ",.!?;"
MEDIA_PLACEHOLDER = "(media)"
LINK_PLACEHOLDER = "(link)"
VIDEO_PLACEHOLDER = "(video)"
UNKNOWN_HANDLE = "~unknown~handle~"
USER_URL_PREFIX = "https://twitter.com/i/user/"
STATUS_URL_PREFIX = "https://twitter.com/"
PHOTO_URL_PREFIX = "https://pbs.twimg.com/media/"
TRANSCRIPT_SEPARATOR = "\n\n----\n\n"
IGNORE_LABEL = -100
# How a transcript shows a local image and a local video (before and after the path).
IMAGE_MARKUP = ("\n![](", ")\n")
VIDEO_MARKUP = ('\n<video controls><source src="', '">Your browser does not support the video tag.</video>\n')
LENGTH_QUANTILES = (0.9, 0.95, 0.97, 0.99, 0.999)


@dataclass(frozen=True)
class CorpusConfig:
    seed: str = "42"
    response_thresh: int = 6
    augmentation_original: int = 2
    augmentation_replies: int = 1
    reply_delimiter: str = "||"
    # cumulative arm thresholds [open question, completion, topic, unconditional]
    arms_without_replies: tuple = (0.35, 0.5, 0.95, 1.0)
    arms_with_replies: tuple = (0.4, 0.5, 0.7, 1.0)
    parse_replies: bool = False
    reply_topic_prob: float = 0.05
    # exponent of the draw of a context's part: 1 draws r texts with a weight of 1 / (r + 1)
    reply_temperature: float = 1.0
    delimiters: str = CJK_DELIMITERS
    topic_trim: str = CJK_TOPIC_TRIM
    # generated-prompt (cache) settings
    max_generated: int = 2
    cache_only: bool = False
    qa_prob: float = 0.75
    seed_open_prob: float = 0.1
    seed_uncond_prob: float = 0.1
    request_max_tokens: int = 128
    request_temperature: float = 0.95
    # identity / transcripts
    max_follower_lookup: int = 5000
    lookup_batch: int = 100
    part_size: int = 1000
    # training-set preparation
    max_seq_length: int = 384
    pad_id: int = 0
    unk_id: int = 1
    bos_id: int = 2
    eos_id: int = 3
    # most frequent tokens that get an id; None: every token
    vocab_size: int | None = None
    batch_size: int = 8
    chat_history_pairs: int = 4
    chat_cutoff: int = 224
    chat_trim_step: int = 15

    def arm_thresholds(self) -> tuple:
        return self.arms_with_replies if self.parse_replies else self.arms_without_replies

    def with_(self, **kw) -> "CorpusConfig":
        return replace(self, **kw)


ASCII = CorpusConfig(delimiters=ASCII_DELIMITERS, topic_trim=ASCII_TOPIC_TRIM)
