"""Names and thresholds that results must agree on (fixed values)."""

from __future__ import annotations

PIPELINE_VERSION = "music-data-pipeline-v1"
SCHEMA_VERSION = "music-data-annotation-v2"

STAGE_ORDER = ["inventory", "music_gate", "discogs_mir", "music_cpu", "structure_raw", "alm", "structure_postprocess", "section_asr", "metadata_merge", "annotation_path"]
FINAL_STAGES = ["music_gate", "discogs_mir", "alm", "music_cpu", "structure_raw", "structure_postprocess", "section_asr"]
PARALLEL_STAGES = ["music_cpu", "structure_raw", "alm"]

AUDIO_EXTENSIONS = ["aac", "aif", "aiff", "alac", "amr", "ape", "dts", "flac", "m4a", "mka", "mp3", "oga", "ogg", "opus", "wav", "wma"]
VIDEO_EXTENSIONS = ["3gp", "avi", "flv", "m2ts", "m4v", "mkv", "mov", "mp4", "mts", "rm", "rmvb", "ts", "vob", "webm", "wmv"]

PROTECTED_LABELS = ["intro", "outro", "bridge", "prechorus", "pre-chorus", "postchorus", "post-chorus", "interlude", "break", "breakdown", "coda", "solo"]
INSTRUMENTAL_LABELS = ["inst", "instrumental", "solo", "gtrbreak", "guitarsolo", "no-vocal-intro", "no-vocal-interlude", "no-vocal-outro"]
BAD_ASR_STATUS = ["not_run", "error", "decode_error", "asr_error", "alignment_error"]
FAILED_ASR_STATUS = ["decode_error", "asr_error", "alignment_error"]
UNSPACED_LANGUAGES = ["chinese", "cantonese", "japanese"]
REMOVED_SECTION_FIELDS = ["key", "key_status", "key_error", "short_caption", "caption_status", "caption_error"]
REMOVED_STAGES = ["section_key", "section_caption"]
REQUIRED_FIELDS = ["audio_id", "audio_path", "source_relpath", "duration", "status", "content_type", "global_caption", "global_mir", "raw_structure", "full_transcript", "sections", "stage_status", "stage_errors", "model_versions", "pipeline_version", "annotation_schema_version"]
RETRY_FIELDS = ["audio_id", "audio_path", "failure_stage", "retryable", "stage_status", "stage_errors", "pipeline_version", "semantic_input_fingerprint"]

#: class indices whose largest probability is a window's music score
MUSIC_CLASSES = [137, *range(27, 38), *range(216, 283)]

STAGE_A = {"reject": 0.05, "accept": 0.35, "offsets": [0.1, 0.5, 0.9]}
STAGE_B = {"reject": 0.10, "accept": 0.30, "offsets": [0.05, 0.25, 0.5, 0.75, 0.95]}
WINDOW_SECONDS = 8.0
VOICE_HOP_SECONDS = 62 * 256 / 16000
VOCAL_SONG, VOCAL_INSTRUMENTAL = 0.55, 0.20
STRUCTURE_FRAME_RATE, STRUCTURE_PEAK_FRAMES = 8.333, 99
