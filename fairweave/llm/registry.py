"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from fairweave.llm.decontamination import OP4_SQL, op4_benchmark_decontamination
from fairweave.llm.language_id import op9_language_id
from fairweave.llm.lm_scoring import op1_lm_scoring
from fairweave.llm.manifest import OP13_SQL, op13_merkle_manifest
from fairweave.llm.media import op7_media_columns
from fairweave.llm.near_dedup import op3_minhash_near_dedup
from fairweave.llm.packing import op8_packing
from fairweave.llm.resampling import OP12_SQL, op12_importance_resampling
from fairweave.llm.secrets import OP2_SQL, op2_secret_scans
from fairweave.llm.sentence_dedup import op6_sentence_dedup
from fairweave.llm.simhash import op11_simhash_near_dedup
from fairweave.llm.substring_dedup import op10_suffix_array_dedup
from fairweave.llm.toxicity import op5_toxicity

QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_secret_scans": op2_secret_scans,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_sentence_dedup": op6_sentence_dedup,
    "op7_media_columns": op7_media_columns,
    "op8_packing": op8_packing,
    "op9_language_id": op9_language_id,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_simhash_near_dedup": op11_simhash_near_dedup,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {"op2_secret_scans": OP2_SQL, "op4_benchmark_decontamination": OP4_SQL, "op12_importance_resampling": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
