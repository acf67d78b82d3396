"""Fixed values.

Everything in this file is a constant that results depend on: tags, weights,
rates, thresholds, character classes. They are data, not logic; callers may
pass their own to every operator.
"""

# Instruction source tags, in union order (first wins in dedup).
SOURCES = ["wizard_zh", "chinese-dpo", "TrufulQA_zh", "sharegpt_zh", "smoltalk_zh"]

# The source whose short instructions are kept and whose rows
# carry reference answers.
ANSWERED_SOURCES = ["TrufulQA_zh"]

# Per-source sampling rates, in output order.
SAMPLE_RATES = {
    "smoltalk_zh": 0.2,
    "sharegpt_zh": 0.3,
    "TrufulQA_zh": 1.0,
    "chinese-dpo": 1.0,
    "wizard_zh": 0.25,
}
SAMPLE_SEED = 42

# Rules for the scored multi-turn source.
DROPPED_PROMPT_KEYS = ["translate", "role-playing", "math23k"]
HALVED_PROMPT_KEY = "document-qa"
MIN_SOURCE_SCORE = 5

# Instruction quality rules.
MIN_INSTRUCTION_LENGTH = 20
MIN_SCRIPT_SHARE = 0.5
REPLACEMENT_CHAR = "�"

# Code points Python counts as whitespace (str.strip, \s).
WHITESPACE_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
    (0x3000, 0x3000),
]

# Zeros of the decimal digits beyond ASCII in Unicode 15.1; the digits
# 1 to 9 follow each.
DIGIT_ZEROS = [
    0x660, 0x6f0, 0x7c0, 0x966, 0x9e6, 0xa66, 0xae6, 0xb66, 0xbe6, 0xc66, 0xce6, 0xd66,
    0xde6, 0xe50, 0xed0, 0xf20, 0x1040, 0x1090, 0x17e0, 0x1810, 0x1946, 0x19d0, 0x1a80,
    0x1a90, 0x1b50, 0x1bb0, 0x1c40, 0x1c50, 0xa620, 0xa8d0, 0xa900, 0xa9d0, 0xa9f0,
    0xaa50, 0xabf0, 0xff10, 0x104a0, 0x10d30, 0x11066, 0x110f0, 0x11136, 0x111d0,
    0x112f0, 0x11450, 0x114d0, 0x11650, 0x116c0, 0x11730, 0x118e0, 0x11950, 0x11c50,
    0x11d50, 0x11da0, 0x11f50, 0x16a60, 0x16ac0, 0x16b50, 0x1d7ce, 0x1d7d8, 0x1d7e2,
    0x1d7ec, 0x1d7f6, 0x1e140, 0x1e2f0, 0x1e4f0, 0x1e950, 0x1fbf0,
]

# Characters an instruction may contain, besides whitespace and
# decimal digits.
ALLOWED_RANGES = [
    (0x4E00, 0x9FFF),            # Han
    (ord("a"), ord("z")),
    (ord("A"), ord("Z")),
    (0x2200, 0x22FF),            # mathematical operators
]
ALLOWED_ASCII_PUNCTUATION = "!@#$%^&*()[],.?\"'/:{}|<>`·-_"
ALLOWED_CJK_PUNCTUATION = "！@#￥%……&*（），。—+【】、；：‘’“”|《》？、"

# What counts as a Han character in the script-share rule.
HAN_RANGES = [(0x4E00, 0x9FA5)]

# The four judged aspects, in judging order.
ASPECTS = ["instruction_following", "honesty", "truthfulness", "helpfulness"]
PLAIN_ASPECTS = ["instruction_following", "honesty"]
TYPED_ASPECTS = ["truthfulness", "helpfulness"]
SLOTS = 4

# Aspect weights in tenths, in summation order, and the one
# aspect that may be left out when it does not apply.
WEIGHT_TENTHS = {
    "instruction_following": 2,
    "truthfulness": 2,
    "helpfulness": 4,
    "honesty": 2,
}
OPTIONAL_ASPECTS = ["honesty"]
NOT_APPLICABLE = "N/A"

# Aspect order inside a chosen/rejected rating record.
RATING_RECORD_ORDER = ["instruction_following", "truthfulness", "helpfulness", "honesty"]

# How often each principle is drawn for a source.
PRINCIPLE_WEIGHTS = {
    "sharegpt_zh": {"helpfulness": 3, "verbalized_calibration": 1, "truthfulness": 1, "honesty": 1},
    "smoltalk_zh": {"helpfulness": 3, "verbalized_calibration": 1, "truthfulness": 1, "honesty": 1},
    "chinese-dpo": {"helpfulness": 3, "verbalized_calibration": 1, "truthfulness": 1, "honesty": 1},
    "wizard_zh": {"helpfulness": 4, "truthfulness": 1, "honesty": 1},
    "TrufulQA_zh": {"honesty": 1, "truthfulness": 1},
}
CALIBRATION_SWAP_RATE = 0.1

# Judgement and critique text markers. Labels stand in this order in a
# section, in any case, with asterisks or none before the colon.
SECTION_MARK = "####"
PLAIN_LABELS = ["Rationale", "Rating"]
TYPED_LABELS = ["Rationale for type", "Type", "Rationale for rating", "Rating"]
CRITIQUE_MARKERS = ["Overall Score: ", "总体评分: "]
STRICT_CRITIQUE_MARKERS = ["Overall Score: "]
NOTE_PREFIX = "Note: "

# Request parameters per stage.
COMPLETION_MAX_TOKENS = 1500
JUDGE_MODEL = "deepseek-chat"
JUDGE_MAX_TOKENS = 1000
JUDGE_TEMPERATURE = 0.0
TOP_P = 0.9
TIMEOUT_SECONDS = 60
BACKOFF_SECONDS = 10

# Chat markers per model family.
CHAT_FAMILIES = {
    "qwen": {
        "prompt": ("<|im_start|>user\n", "<|im_end|>\n<|im_start|>assistant\n"),
        "end": "<|im_end|>",
        "answer_tail": "<|im_end|>\n",
    },
    "llama3": {
        "prompt": (
            "<|start_header_id|>user<|end_header_id|>\n\n",
            "\n<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n",
        ),
        "end": "<|eot_id|>",
        "answer_tail": "<|eot_id|>",
    },
}
MAX_TRAINING_TOKENS = 2048

# Completion models and their call settings.
MODEL_POOL = {
    "deepseek-chat": {"temperature": 1.0},
    "gpt-4o-mini": {"temperature": 1.0},
    "qwen2.5-72b": {"temperature": 1.0},
    "qwen2-7b": {"temperature": 1.0},
    "qwen2.5-1.5b": {"temperature": 1.0},
    "phi3.5-mini": {"temperature": 1.0},
    "llama3.1-8b-chinese": {"temperature": 1.0},
    "mistral-v0.1-chinese": {"temperature": 1.0},
    "glm-4-9b-chat": {"temperature": 1.0},
}
# Substring of the model name -> provider, first match wins.
PROVIDER_SUBSTRINGS = [("gpt-4o", "gpt-4o"), ("deepseek", "deepseek"), ("gemini", "gemini")]
