"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from flowmart.llm.collocations import OP13_SQL, op13_phrase_collocations
from flowmart.llm.decontaminate import op2_template_decontamination
from flowmart.llm.interpolation import op8_deleted_interpolation
from flowmart.llm.langid import op1_crf_language_id
from flowmart.llm.linededup import OP9_SQL, op9_line_dedup
from flowmart.llm.minhash import OP11_SQL, op11_minhash_near_dedup
from flowmart.llm.mixing import op7_source_mixing
from flowmart.llm.permindex import op3_permutation_index
from flowmart.llm.quality import op10_quality_neighbours
from flowmart.llm.simhash import op5_simhash_near_dedup
from flowmart.llm.toxicity import op4_toxicity_segments
from flowmart.llm.urlfilter import op6_url_filter
from flowmart.llm.whitening import op12_embedding_whitening

QUERIES = {
    q.__name__: q
    for q in (
        op1_crf_language_id,
        op2_template_decontamination,
        op3_permutation_index,
        op4_toxicity_segments,
        op5_simhash_near_dedup,
        op6_url_filter,
        op7_source_mixing,
        op8_deleted_interpolation,
        op9_line_dedup,
        op10_quality_neighbours,
        op11_minhash_near_dedup,
        op12_embedding_whitening,
        op13_phrase_collocations,
    )
}
SQL = {"op9_line_dedup": OP9_SQL, "op11_minhash_near_dedup": OP11_SQL, "op13_phrase_collocations": OP13_SQL}
