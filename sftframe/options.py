"""Typed options.  Every option is checked when the object is made, before any job starts."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# Special token texts, the label value that a loss skips, timed phases.
EOS_TOKEN = "<|endoftext|>"
UNK_TOKEN = "[UNK]"
PAD_TOKEN = "[PAD]"
IGNORE_ID = -100
PHASES = ("forward", "backward", "build_batch", "optimizer_step")


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


def resolve_max_length(option: int | None, tokenizer_limit: int, model_limit: int, single_process: bool = False) -> int:
    """Context limit in tokens.

    Multi-process runs take the least of the three limits.  The single-process run uses the option, or the
    tokenizer limit when no option is given, and caps that by the model limit only.
    """
    if single_process:
        return min(option or tokenizer_limit, model_limit)
    _require(option is not None, "max_length is required")
    return min(option, tokenizer_limit, model_limit)


@dataclass(frozen=True)
class SftOptions:
    """Options of an instruction-tuning run."""

    instruction_col: str = "instruction"
    response_col: str = "response"
    id_col: str = "pair_id"
    template: str = "v2"
    prompt_template: str = "v1"
    eos_token: str = EOS_TOKEN
    vocab_size: int = 50_000
    max_length: int = 1024
    test_split: Decimal = Decimal("0.1")
    single_process: bool = False
    world_size: int = 1
    batch_size: int = 16
    num_epochs: int = 12
    seed: int = 42
    ignore_id: int = IGNORE_ID
    mask_instruction: bool = False
    shift_labels: bool = False
    min_pads_to_mask: int = 2
    align_shifted_mask: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "test_split", Decimal(str(self.test_split)))
        low_ok = self.test_split > 0 if self.single_process else self.test_split >= 0
        _require(low_ok and self.test_split <= 1, f"test_split out of range: {self.test_split}")
        _require(self.template in ("v1", "v2"), f"unknown template {self.template!r}")
        _require(self.prompt_template in ("v1", "v2"), f"unknown prompt_template {self.prompt_template!r}")
        for name in ("vocab_size", "max_length", "world_size", "batch_size", "num_epochs", "min_pads_to_mask"):
            value = getattr(self, name)
            _require(isinstance(value, int) and value >= 1, f"{name} must be a positive integer, not {value!r}")
        for name in ("mask_instruction", "shift_labels", "align_shifted_mask", "single_process"):
            _require(isinstance(getattr(self, name), bool), f"{name} must be True or False")
        _require(not self.single_process or self.world_size == 1, "a single-process run has world_size 1")


@dataclass(frozen=True)
class PreferenceOptions:
    """Options of a preference-tuning run."""

    strategy: str = "regul"
    beta: float = 0.1
    length_alpha: float = 0.4
    ld_alpha: float = 0.4
    length_normalised: bool = False
    rpo_alpha: float | None = None
    use_weighting: bool = False
    aux_loss_coef: float | None = None
    nll_mask: str = "label"
    report_nll: bool = False
    encoder_decoder: bool = False
    max_length: int | None = None
    truncation_mode: str = "keep_end"
    batch_size: int = 8
    seed: int = 42

    def __post_init__(self) -> None:
        _require(self.strategy in ("regul", "ld"), f"strategy must be 'regul' or 'ld', not {self.strategy!r}")
        _require(self.truncation_mode in ("keep_start", "keep_end"), f"unknown truncation mode {self.truncation_mode!r}")
        _require(self.nll_mask in ("label", "loss_mask"), f"nll_mask must be 'label' or 'loss_mask', not {self.nll_mask!r}")
        _require(self.max_length is None or self.max_length >= 1, "max_length must be positive")
        _require(self.batch_size >= 1, "batch_size must be positive")


@dataclass(frozen=True)
class DecodeOptions:
    """How the next token is chosen from a row of scores, and when generation stops."""

    top_k: int | None = None
    temperature: float = 0.0
    repetition_penalty: float = 1.0
    max_new_tokens: int = 100
    context_size: int = 1024
    request_batch: int = 64
    seed: int = 42

    def __post_init__(self) -> None:
        _require(self.top_k is None or self.top_k >= 1, "top_k must be positive")
        _require(self.temperature >= 0, "temperature must not be negative")
        _require(self.repetition_penalty > 0, "repetition_penalty must be positive")
        for name in ("max_new_tokens", "context_size", "request_batch"):
            _require(getattr(self, name) >= 1, f"{name} must be positive")


@dataclass(frozen=True)
class LogOptions:
    """How training steps are summarised."""

    log_freq: int = 100
    checkp_freq: int = 500
    batch_size: int = 16
    max_length: int = 1024
    world_size: int = 1
    batches: int = 1
    num_epochs: int = 12
    lr: float = 1e-5
    weight_decay: float = 0.01

    def __post_init__(self) -> None:
        for name in ("log_freq", "checkp_freq", "batch_size", "max_length", "world_size", "batches", "num_epochs"):
            _require(getattr(self, name) >= 1, f"{name} must be positive")
        _require(self.lr > 0, "lr must be positive")
