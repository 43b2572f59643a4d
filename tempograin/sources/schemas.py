"""Declared schemas of the raw tables and of the audience contract.

Fixed values: the names and types that other tools read and write.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

EMOTIONS = ("neutral", "happiness", "surprise", "sadness", "anger", "disgust", "fear", "contempt")
_P = ", ".join(f"p_{e} double" for e in EMOTIONS)
_BOX = "x0 double, y0 double, x1 double, y1 double, area_frac double"

_RAW_DDL = {
    "creative_metadata": "creative_id string, title string, source_label string, file_name string, file_sha256 string, file_size_bytes long, container string, duration_s double, width long, height long, aspect_ratio double, orientation string, fps double, n_video_frames long, video_codec string, pix_fmt string, video_bitrate_kbps long, total_bitrate_kbps long, has_audio boolean, audio_codec string, audio_sample_rate long, audio_channels long, sampled_frame_hz double, n_sampled_frames long",
    "sampling_config": "creative_id string, extractor string, sample_hz double, frame_hz double, step_frames long",
    "shot_boundaries": "creative_id string, shot_index long, start_s double, end_s double, duration_s double, start_frame long, end_frame long",
    "transcript_segments": "creative_id string, segment_index long, start_s double, end_s double, text string, n_words long, words_per_s double, avg_logprob double, no_speech_prob double, compression_ratio double",
    "transcript_words": "creative_id string, segment_index long, word_index long, word string, start_s double, end_s double, probability double",
    "transcript_summary": "creative_id string, language string, language_probability double, model string, n_segments long, n_words long, speech_s double, speech_share double, words_per_minute double",
    "visual_frames": "creative_id string, frame_index long, t_start_s double, t_end_s double, brightness double, brightness_std double, saturation double, contrast double, colourfulness double, sharpness double, edge_density double, dominant_hue_deg double, motion_abs_diff double, hist_distance double, is_near_black boolean",
    "audio_frames": "creative_id string, frame_index long, t_start_s double, t_end_s double, rms float, dbfs float, spectral_centroid_hz double, spectral_flatness float, spectral_rolloff_hz double, zero_crossing_rate double, onset_strength float, harmonic_ratio float, is_silent boolean",
    "audio_summary": "creative_id string, tempo_bpm double, n_beats long, mean_dbfs double, peak_dbfs double, dynamic_range_db double, silence_share double, mean_harmonic_ratio double, sample_rate long",
    "screen_text_detections": f"creative_id string, frame_index long, t_start_s double, detection_index long, text string, n_chars long, score double, {_BOX}, height_frac double, centre_y double",
    "face_detections": f"creative_id string, frame_index long, t_start_s double, face_index long, score double, {_BOX}, centre_x double, centre_y double, is_largest boolean, emotion_top string, emotion_top_prob double, {_P}",
    "object_detections": f"creative_id string, frame_index long, t_start_s double, detection_index long, class_id long, class_name string, score double, {_BOX}",
    "shot_label_scores": "creative_id string, shot_index long, axis string, label string, score double, rank long, is_top boolean, n_frames_scored long",
    "_manifest": "creative_id string, creative_sha256 string, extractor string, extractor_version string, status string, rows_written long, tables string, run_id string, finished_at string, duration_s double, error string",
}
_AUDIENCE_DDL = {
    "viewers": "viewer_id string, age long, age_band string, gender string, region string, income_band string, device string, environment string, recruitment_source string, consent_biometric boolean, trait_attention double, trait_expressiveness double, trait_acquiescence double, latent_implicit_pref double, data_source string",
    "sessions": "session_id string, viewer_id string, creative_id string, started_at timestamp, device string, environment string, watch_time_s long, creative_duration_s long, completed boolean, consent_biometric boolean, data_source string",
    "biometric_seconds": f"session_id string, creative_id string, viewer_id string, second int, attention_index double, gaze_on_screen boolean, face_detected boolean, valence double, arousal double, {_P}, data_source string",
    "survey_questions": "question_id string, question_text string, response_type string, data_source string",
    "survey_responses": "session_id string, viewer_id string, creative_id string, question_id string, response_type string, value_numeric long, data_source string",
    "iat_trials": "viewer_id string, block string, trial_index long, is_congruent boolean, reaction_time_ms double, is_error boolean, data_source string",
    "iat_scores": "viewer_id string, mean_rt_congruent_ms double, mean_rt_incongruent_ms double, pooled_sd_ms double, n_valid_trials long, d_score double, data_source string",
    "generator_params": "component string, parameter string, value double, data_source string",
    "generator_manifest": "run_id string, generator_version string, seed long, n_viewers long, n_sessions long, n_biometric_rows long, generated_at string, data_source string",
}
LANDING_DDL = f"session_id string, viewer_id string, creative_id string, second int, attention_index double, gaze_on_screen boolean, face_detected boolean, valence double, arousal double, {_P}, data_source string, batch_id string, received_at string"



def _schema(ddl: str) -> StructType:
    """Plain types only, so no session is needed to declare a schema."""
    out = StructType()
    for column in ddl.split(", "):
        name, kind = column.split()
        out = out.add(name, {"int": "integer"}.get(kind, kind))
    return out


RAW = {n: _schema(d) for n, d in _RAW_DDL.items()}
AUDIENCE = {n: _schema(d) for n, d in _AUDIENCE_DDL.items()}
LANDING = _schema(LANDING_DDL)
