"""Declarative source specifications.

A corpus is built from many sources whose files differ in layout, text column,
audio representation and speaker rule.  Everything that differs is data here;
the plans in :mod:`voxloom.plans` are the same for every source.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class SignalParams:
    """Waveform targets and gate limits."""

    target_sr: int = 16000
    min_s: float = 0.3
    max_s: float = 40.0
    clip_amp: float = 0.999
    clip_ms: float = 10.0

    @property
    def min_run(self) -> int:
        """Shortest run of clipped samples that counts as clipping."""
        return max(1, int(self.clip_ms * self.target_sr / 1000))


@dataclass(frozen=True)
class SourceSpec:
    name: str
    path: str
    text_cols: tuple[str, ...]
    audio_col: str = "audio"
    rate_col: str | None = None
    # "encoded" struct<bytes,path> | "binary" | "samples" array<float> | "auto"
    audio_kind: str = "auto"
    codec: str = "wav"
    # "literal" | "column" | "config"
    speaker_rule: str = "literal"
    speaker: str = ""
    # "prefix" (of the file name) | "constant" | "config"
    split_rule: str = "prefix"
    split: str = "train"
    # the row counter restarts per split, or runs over the whole source
    index_scope: str = "split"
    rows_per_file: int = 1024
    # put before the reason of a signal failure, so that the drop log can be counted by prefix
    reason_prefix: str = "audio: "
    configs: dict[str, str] = field(default_factory=dict)
    signal: SignalParams = SignalParams()

    def with_signal(self, **changes) -> SourceSpec:
        return replace(self, signal=replace(self.signal, **changes))

    def config_short(self, config: str) -> str:
        return self.configs.get(config, config)


AUDIO_FIELDS = ("audio", "speech", "waveform", "wav")  # fixed values: field names looked for, in this order

# Short names of the configurations of the multi-config source.
CONFIG_SHORT = {
    "common_voice_17": "cv17",
    "fleurs": "fleurs",
    "youtube": "youtube",
    "yazdi_accent": "yazdi",
}
# The configuration reported under the bare source name; the others are reported as <source>_<short>.
DEFAULT_CONFIG_SHORT = "youtube"

_LIMIT_30 = SignalParams(max_s=30.0)

# The registered sources, their columns, speaker labels, limits and file sizes.
REGISTRY: tuple[SourceSpec, ...] = (
    SourceSpec("vhdm", "vhdm", ("corrected_sentence",), audio_kind="encoded", codec="mp3",
               speaker="vhdm_spk0000", signal=_LIMIT_30),
    SourceSpec("asr_fa_v1", "asr_fa_v1", ("corrected_sentence",), audio_kind="encoded", codec="mp3",
               speaker="gen:asr_fa_v1_spk0000", signal=_LIMIT_30),
    SourceSpec("hezarai_cv13", "hezarai_cv13", ("sentence",), audio_kind="encoded", codec="mp3",
               speaker_rule="column", speaker="client_id"),
    SourceSpec("seyedali", "seyedali", ("transcript",), audio_kind="encoded",
               speaker_rule="column", speaker="speaker_id"),
    SourceSpec("pourmand", "pourmand", ("transcription",), audio_kind="encoded", codec="mp3",
               speaker="gen:pourmand_spk0000"),
    SourceSpec("m522t", "m522t", ("sentence",), audio_kind="encoded", speaker="gen:m522t_spk0000"),
    SourceSpec("mshojaei", "mshojaei", ("sentence",), audio_kind="encoded", codec="mp3",
               speaker="gen:mshojaei_spk0000", rows_per_file=4096),
    SourceSpec("kiarash", "kiarash", ("text",), audio_kind="binary", codec="wav/mp3",
               speaker="gen:kiarash_spk0000", split_rule="constant", index_scope="source"),
    SourceSpec("mana_tts", "mana_tts/dataset", ("transcript",), rate_col="samplerate", audio_kind="samples",
               speaker="gen:mana_tts_spk0000", split_rule="constant", rows_per_file=4096, reason_prefix="",
               signal=_LIMIT_30),
    SourceSpec("gpt_informal", "gpt_informal/dataset", ("transcript",), rate_col="samplerate",
               audio_kind="samples", speaker="gen:gpt_informal_spk0000", split_rule="constant"),
    SourceSpec("thomcles", "thomcles", ("sentence", "text", "transcription", "transcript"),
               speaker="gen:thomcles_spk0000", split_rule="constant", index_scope="source"),
    SourceSpec("srezas", "srezas", ("sentence",), audio_kind="encoded", codec="mp3",
               speaker_rule="config", speaker="gen:srezas_%s_spk0000", split_rule="config",
               rows_per_file=4096, configs=CONFIG_SHORT),
    SourceSpec("pertts", "pertts", ("sentence",), audio_kind="encoded",
               speaker="gen:pertts_spk0000", split_rule="constant"),
)


def spec_for(name: str) -> SourceSpec:
    for spec in REGISTRY:
        if spec.name == name:
            return spec
    raise KeyError(f"unknown source {name!r}")
