"""Registered queries by name, with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ribolith.functions import sequence as S
from ribolith.operators import alignments as A
from ribolith.operators import counts as C
from ribolith.operators import curves as K
from ribolith.operators import database as D
from ribolith.operators import identifications as I
from ribolith.operators import intervals as J
from ribolith.operators import startsites as P
from ribolith.operators import variants as V
from ribolith.plans.registry import ORACLES, QUERIES, query as _query
from ribolith.sources import adapters as T
from ribolith.sources import files as W



def _points(spark, sf_dir):
    return C.merged(T.psite(spark, sf_dir))


_POINTS = "points as (select chr, strand, start, cast(sum(cnt) as bigint) cnt from psite group by 1, 2, 3)"
_CDNA = """cd as (select *, cast(coalesce(sum(exon_end - exon_start + 1) over (partition by transcript_id order by rank rows between unbounded preceding and 1 preceding), 0) + 1 as bigint) cdna_start from exons)"""
_HIT = """hit as (select p.chr, p.strand, p.start, p.cnt, transcript_id, rank, c.cdna_start + case when p.strand = 1 then p.start - exon_start else exon_end - p.start end cdna
 from points p join cd c on p.chr = c.chr and p.strand = c.strand and p.start between exon_start and exon_end)"""
_SIZE = "size_ as (select transcript_id, cast(sum(exon_end - exon_start + 1) as bigint) length from exons group by 1)"
_EXON_CTES = T.ctes("psite", "exons") + f",\n{_POINTS},\n{_CDNA},\n{_HIT},\n{_SIZE}\n"


@_query(T.ctes("psite", "features") + f""", {_POINTS}
select feature_id, cast(sum(cnt) as bigint) counts_sum, count(*) counts_n from points p join features f
on p.chr = f.chr and p.strand = f.strand and p.start between feature_start and feature_end group by 1""")
def feature_counts(spark, sf_dir):
    return C.feature_counts(_points(spark, sf_dir), T.features(spark, sf_dir))


@_query(T.ctes("psite", "features") + f""", {_POINTS}
select coalesce(feature_id, -1) feature_id, cast(sum(cnt) as bigint) reads from points p left join features f
on p.chr = f.chr and p.strand = f.strand and p.start between feature_start and feature_end group by 1""")
def gene_distribution(spark, sf_dir):
    return C.gene_distribution(_points(spark, sf_dir), T.features(spark, sf_dir))


_TYPED = "case when feature_id % 3 = 0 then 'exon' when feature_id % 3 = 1 then 'intron' else 'noncoding' end"


@_query(T.ctes("psite", "features") + f""", {_POINTS}, typed as (select *, {_TYPED} kind, feature_id % 3 priority from features),
best as (select p.chr, p.strand, p.start, max(cnt) cnt, arg_min(kind, priority) kind from points p left join typed f
on p.chr = f.chr and p.strand = f.strand and p.start between feature_start and feature_end group by 1, 2, 3)
select chr, coalesce(kind, 'intergenic') kind, cast(sum(cnt) as bigint) reads from best group by 1, 2""")
def metagenic(spark, sf_dir):
    typed = T.features(spark, sf_dir).withColumn("kind", F.expr(_TYPED)).withColumn("priority", F.expr("feature_id % 3"))
    return C.metagenic(_points(spark, sf_dir), typed)


@_query(T.ctes("features") + """ select distinct a.feature_id, b.feature_id other from features a join features b
on a.chr = b.chr and a.strand = b.strand and a.feature_start <= b.feature_end and a.feature_end >= b.feature_start and a.feature_id <> b.feature_id""")
def feature_overlaps(spark, sf_dir):
    f = T.features(spark, sf_dir)
    return J.overlaps(f, f.withColumnRenamed("feature_id", "other"), "feature_id", "other", "feature_start", "feature_end", unique=True).where("feature_id <> other")


@_query(T.ctes("features") + """, coding as (select * from features where feature_id % 2 = 0), non as (select * from features where feature_id % 2 = 1)
select feature_id from coding a where not exists (select 1 from non b where a.chr = b.chr and a.strand = b.strand and a.feature_start <= b.feature_end and a.feature_end >= b.feature_start)""")
def coding_without_overlap(spark, sf_dir):
    f = T.features(spark, sf_dir)
    coding, non = f.where("feature_id % 2 = 0"), f.where("feature_id % 2 = 1").withColumnRenamed("feature_id", "other")
    met = J.overlaps(coding, non, "feature_id", "other", "feature_start", "feature_end")
    return coding.join(met, "feature_id", "left_anti").select("feature_id")


@_query(T.ctes("exons") + f""", {_CDNA} select transcript_id, cast(rank as integer) as rank, cdna_start, cdna_start + exon_end - exon_start cdna_end from cd""")
def exon_offsets(spark, sf_dir):
    return J.with_cdna(T.exons(spark, sf_dir)).select("transcript_id", "rank", "cdna_start", "cdna_end")


@_query(_EXON_CTES + " select transcript_id, start, cdna, cast((cdna - 1) % 3 as integer) phase, cnt from hit")
def transcript_positions(spark, sf_dir):
    return C.exon_hits(_points(spark, sf_dir), T.exons(spark, sf_dir)).select("transcript_id", "start", "cdna", "phase", "cnt")


@_query(T.ctes("exons") + f""", {_CDNA}, t as (select *, cdna_start + exon_end - exon_start cdna_end, max(cdna_start + exon_end - exon_start) over (partition by transcript_id) n from cd),
c as (select *, greatest(cdna_start, 16) lo, least(cdna_end, n - 15) hi from t)
select transcript_id, cast(rank as integer) as rank, case when strand = 1 then exon_start + lo - cdna_start else exon_start + cdna_end - hi end clip_start,
case when strand = 1 then exon_end - (cdna_end - hi) else exon_end - (lo - cdna_start) end clip_end from c where lo <= hi""")
def clipped_cds(spark, sf_dir):
    return J.clip_cds(T.exons(spark, sf_dir)).select("transcript_id", "rank", "clip_start", "clip_end")


@_query(_EXON_CTES + """, mapped as (select sum(cnt) mapped from points), s as (select transcript_id, cast(sum(cnt) as bigint) reads, count(*) covered from hit group by 1)
select transcript_id, reads, covered, round(covered / length, 6) coverage, round(reads * 1e9 / (length * mapped), 6) fpkm from s join size_ using (transcript_id) cross join mapped""")
def transcript_coverage(spark, sf_dir):
    points = _points(spark, sf_dir)
    return C.transcript_coverage(points, T.exons(spark, sf_dir), points.agg(F.sum("cnt").alias("mapped")))


@_query(_EXON_CTES + """, s as (select transcript_id, rank, sum(cnt) reads from hit group by 1, 2),
e as (select x.transcript_id, x.rank, coalesce(reads, 0) reads, coalesce(reads, 0) / (exon_end - exon_start + 1) norm from exons x left join s on x.transcript_id = s.transcript_id and x.rank = s.rank),
m as (select *, avg(norm) over (partition by transcript_id) mean from e),
g as (select transcript_id, cast(sum(reads) as bigint) reads, count(*) filter (norm < mean * 0.2) noisy, count(*) exons from m group by 1)
select transcript_id, reads, noisy, exons, case when noisy / exons < 0.15 then 'Yes' else 'No' end exon_coverage from g where reads > 0""")
def translated_transcripts(spark, sf_dir):
    return C.translated(_points(spark, sf_dir), T.exons(spark, sf_dir))


@_query(_EXON_CTES + """, c as (select h.*, length n, case when length > 300 then 15 else floor(length * 15 / 300) end cut from hit h join size_ using (transcript_id))
select transcript_id, cast(coalesce(sum(cnt) filter (cdna <= cut), 0) as bigint) pre_count, cast(coalesce(sum(cnt) filter (cdna > cut and cdna <= n - cut), 0) as bigint) count,
cast(coalesce(sum(cnt) filter (cdna > n - cut and cdna > cut), 0) as bigint) post_count from c group by 1""")
def orf_counts(spark, sf_dir):
    return C.orf_counts(_points(spark, sf_dir), T.exons(spark, sf_dir))


@_query(T.ctes("psite", "exons") + f""", {_CDNA}, h as (select p.rpf, p.cnt, (c.cdna_start + case when p.strand = 1 then p.start - exon_start else exon_end - p.start end - 1) % 3 ph
from psite p join cd c on p.chr = c.chr and p.strand = c.strand and p.start between exon_start and exon_end)
select rpf, cast(coalesce(sum(cnt) filter (ph = 0), 0) as bigint) phase0, cast(coalesce(sum(cnt) filter (ph = 1), 0) as bigint) phase1, cast(coalesce(sum(cnt) filter (ph = 2), 0) as bigint) phase2 from h group by 1""")
def phase_by_length(spark, sf_dir):
    return C.phase_by_length(T.psite(spark, sf_dir), T.exons(spark, sf_dir))


@_query(_EXON_CTES + """, k as (select h.*, length, cast((cdna - 1) % 3 as integer) phase, sum(cnt) over (partition by transcript_id) / length mean from hit h join size_ using (transcript_id)),
g as (select transcript_id, length, max(mean) mean, sum(cnt) reads, coalesce(sum(cnt) filter (phase = 0), 0) reads0, coalesce(sum((cnt - mean) * (cnt - mean)) filter (phase = 0), 0) dev,
count(*) filter (phase = 0) n0, count(*) filter (cnt > mean) above from k group by 1, 2)
select transcript_id, round(reads0 / reads, 6) ifc, round(dev + (floor((length + 2) / 3) - n0) * mean * mean, 6) ifc_stat, round(above / length, 6) spread from g""")
def frame_metrics(spark, sf_dir):
    return C.frame_metrics(_points(spark, sf_dir), T.exons(spark, sf_dir))


@_query(_EXON_CTES + """ select cast(floor(cdna * 20 / (length + 1)) as integer) bin, cast((cdna - 1) % 3 as integer) phase, count(*) positions from hit join size_ using (transcript_id) group by 1, 2""")
def phase_histogram(spark, sf_dir):
    return C.phase_histogram(_points(spark, sf_dir), T.exons(spark, sf_dir))


@_query(ORACLES["feature_counts"].replace("select feature_id,", ", fc as (select feature_id,", 1).replace(", fc", ", fc", 1) + """)
select feature_id, counts_sum, row_number() over (order by counts_sum desc, feature_id) as rank,
round(sum(counts_sum) over (order by counts_sum desc, feature_id rows unbounded preceding) / sum(counts_sum) over (), 6) cumulative from fc""")
def gene_rank_curve(spark, sf_dir):
    return C.rank_curve(C.feature_counts(_points(spark, sf_dir), T.features(spark, sf_dir)))


@_query(T.ctes("psite", "features") + """, s as (select feature_id, rpf, sum(cnt) reads from psite p join features f on p.chr = f.chr and p.strand = f.strand and p.start between feature_start and feature_end group by 1, 2),
r as (select rpf, sum(reads) / (select sum(reads) from s) ref from s group by 1),
d as (select feature_id, s.rpf, reads, reads / sum(reads) over (partition by feature_id) fraction from s)
select feature_id, cast(sum(reads) as bigint) nreads, round(sum(abs(fraction - ref)) / 2, 6) floss from d join r using (rpf) group by 1""")
def floss_scores(spark, sf_dir):
    psite, features = T.psite(spark, sf_dir), T.features(spark, sf_dir)
    return C.floss(psite, features, C.reference_fractions(psite, features))


@_query(_EXON_CTES + """, k as (select *, (cdna - 1) % 3 ph, sum(cnt) over (partition by transcript_id) total from hit),
g as (select transcript_id, coalesce(sum(cnt) filter (ph = 0), 0) f0, coalesce(sum(cnt) filter (ph = 1), 0) f1, coalesce(sum(cnt) filter (ph = 2), 0) f2 from k where cnt < 0.7 * total group by 1),
m as (select *, (f0 + f1 + f2) / 3 m from g)
select transcript_id, round(case when f0 > f1 and f0 > f2 then 1 else -1 end * log2(1 + ((f0 - m) * (f0 - m) + (f1 - m) * (f1 - m) + (f2 - m) * (f2 - m)) / m), 6) + 0.0 orfscore from m""")
def orfscores(spark, sf_dir):
    return C.orfscore(_points(spark, sf_dir), T.exons(spark, sf_dir))


@_query(_EXON_CTES + """, k as (select transcript_id, cdna, cnt, max(cnt) over (partition by transcript_id order by cdna range between 3 preceding and 3 following) top from hit)
select transcript_id, cdna, cnt from k where cnt >= top""")
def local_maxima(spark, sf_dir):
    return C.local_maxima(_points(spark, sf_dir), T.exons(spark, sf_dir))


# P-sites of plain, one-intron and clipped alignments in closed form.
_PSITE = T.ctes("alignments") + r""", p as (select *, case when flag & 16 != 0 then -1 else 1 end strand,
 case when cigar like '%N%' then 'i' when cigar like '%S%' then 's' else 'm' end kind, cast(regexp_extract(cigar, '(\d+)M', 1) as integer) m1 from alignments),
l as (select *, case kind when 'i' then m1 + 20 when 's' then m1 + case when strand = 1 then 0 else 0 end else m1 end len from p),
o as (select *, case when least(greatest(len, 26), 34) <= 30 then 12 when least(greatest(len, 26), 34) <= 33 then 13 else 14 end off from l),
q as (select *, cast(case when kind <> 'i' then case when strand = 1 then pos + off else pos + m1 - 1 - off end
 when strand = 1 then pos + off + case when off >= m1 then 100 else 0 end
 else pos + m1 + 100 + 20 - 1 - off - case when off >= 20 then 100 else 0 end end as bigint) psite from o)
"""


@_query(_PSITE + "select l_orderkey, l_linenumber, chr, strand, cast(len as integer) len, psite from q")
def psite_positions(spark, sf_dir):
    return A.with_psites(T.alignments(spark, sf_dir)).select("l_orderkey", "l_linenumber", "chr", "strand", "len", "psite")


@_query(_PSITE + "select chr, strand, psite as start, cast(len as integer) rpf, count(*) cnt from q group by 1, 2, 3, 4")
def psite_counts_by_length(spark, sf_dir):
    return A.psite_counts_by_length(A.with_psites(T.alignments(spark, sf_dir)))


@_query(_PSITE + "select chr, strand, psite as start, count(*) cnt from q where len between 26 and 34 group by 1, 2, 3")
def psite_counts(spark, sf_dir):
    return A.psite_counts(A.with_psites(T.alignments(spark, sf_dir)))


@_query(_PSITE + "select chr, cast(len as integer) len, count(*) reads from q group by 1, 2")
def length_distribution(spark, sf_dir):
    return A.length_distribution(A.with_psites(T.alignments(spark, sf_dir)))


@_query(T.ctes("alignments") + """ select chr, count(*) total, count(*) filter (nh = 1) mapped_u, count(*) filter (nh > 1) mapped_m,
round(count(*) filter (nh = 1) / count(*), 5) freq_u, round(count(*) filter (nh > 1) / count(*), 5) freq_m from alignments group by 1""")
def mapping_statistics(spark, sf_dir):
    return A.mapping_statistics(T.alignments(spark, sf_dir))


@_query(T.ctes("alignments") + r""", b as (select chr, case when flag & 16 != 0 then -1 else 1 end strand, pos, case when cigar like '%N%' then list_concat(range(0, cast(regexp_extract(cigar, '(\d+)M', 1) as int)), range(cast(regexp_extract(cigar, '(\d+)M', 1) as int) + 100, cast(regexp_extract(cigar, '(\d+)M', 1) as int) + 120))
 else range(0, cast(regexp_extract(cigar, '(\d+)M', 1) as int)) end bases from alignments),
t as (select chr, strand, pos, len(bases) - 24 n, unnest(bases[13:len(bases) - 12]) at_ from b where len(bases) > 24)
select chr, strand, cast(pos + at_ as bigint) as start, round(sum(1.0 / n), 6) as value from t group by 1, 2, 3""")
def fractional_counts(spark, sf_dir):
    return A.fractional_counts(T.alignments(spark, sf_dir)).withColumn("value", F.round("value", 6))


@_query(T.ctes("alignments") + """ select chr, pos, case when flag & 16 != 0 then -1 else 1 end strand, cigar, min(struct_pack(a := l_orderkey, b := l_linenumber)).a l_orderkey from alignments group by 1, 2, 3, 4""")
def unmarked_duplicates(spark, sf_dir):
    return A.mark_duplicates(T.alignments(spark, sf_dir), ["l_orderkey", "l_linenumber"]).select("chr", "pos", "strand", "cigar", "l_orderkey")


@_query(T.ctes("alignments") + " select l_orderkey, l_linenumber from alignments where (mapq = 255 or nh = 1) and nh < 3")
def unique_reads(spark, sf_dir):
    return A.filter_reads(T.alignments(spark, sf_dir), unique=True, max_hits=3).select("l_orderkey", "l_linenumber")


@_query(T.ctes("dna") + " select doc_id, reverse(translate(seq, 'ACGT', 'TGCA')) rc from dna")
def reverse_complements(spark, sf_dir):
    return T.dna(spark, sf_dir).select("doc_id", S.reverse_complement(F.col("seq")).alias("rc"))


_CODE = "map {" + ", ".join(f"'{c}': '{a}'" for c, a in sorted(S.codon_table().items()) if "N" not in c) + "}"
_TRANSLATED = T.ctes("dna") + f""", code as (select {_CODE} m), t as (select doc_id, array_to_string(list_transform(regexp_extract_all(seq, '...'), lambda c: m[c]), '') aa from dna cross join code)
"""


@_query(_TRANSLATED + "select doc_id, split_part(aa, '*', 1) aa from t")
def translations(spark, sf_dir):
    return T.dna(spark, sf_dir).select("doc_id", S.translate_codons(F.col("seq")).alias("aa"))


@_query(T.ctes("dna") + """, b as (select doc_id, unnest(string_split(seq, '')) x, generate_subscripts(string_split(seq, ''), 1) i from dna where length(seq) > 0),
c as (select doc_id, i, x || lead(x, 1) over w || lead(x, 2) over w codon from b window w as (partition by doc_id order by i)),
e as (select *, min(i) filter (codon in ('TAA', 'TAG', 'TGA')) over (partition by doc_id, i % 3 order by i rows between current row and unbounded following) stop from c)
select doc_id, cast(i as integer) as start, cast(stop + 2 as integer) as "end", codon from e where codon in ('ATG', 'CTG', 'TTG', 'GTG') and (stop - i) / 3 >= 9""")
def open_reading_frames(spark, sf_dir):
    return T.dna(spark, sf_dir).select("doc_id", F.explode(S.find_orfs(F.col("seq"), 10)).alias("o")).select("doc_id", "o.start", "o.end", "o.codon")


@_query(T.ctes("protein") + """ select doc_id, array_to_string(list_reverse(regexp_extract_all(aa, '([KR]*[^KR]|[KR]+$)')), '') decoy from protein""")
def decoys(spark, sf_dir):
    return T.protein(spark, sf_dir).select("doc_id", S.decoy(F.col("aa")).alias("decoy"))


@_query(T.ctes("protein") + """, g as (select aa, list_sort(list(doc_id)) ids from protein group by 1)
select ids[1] doc_id, md5(aa) aa, array_to_string(list_transform(ids[2:], lambda x: 'dupl_' || x), ' ') duplicates from g""")
def deduplicated_proteins(spark, sf_dir):
    return D.deduplicate(T.protein(spark, sf_dir), "doc_id", "aa").withColumn("aa", F.md5("aa"))


@_query(T.ctes("protein") + """, a as (select * from protein where doc_id % 3 <> 0), b as (select * from protein where doc_id % 3 <> 1),
u as (select 0 f, * from a union all select 1, * from b), g as (select aa, max(case when f = 0 then '1' else '0' end) || max(case when f = 1 then '1' else '0' end) bincode, list_sort(list(struct_pack(f := f, d := doc_id))) m from u group by 1)
select m[1].d doc_id, bincode, array_to_string(list_transform(m[2:], lambda x: x.d::varchar), '#') side, md5(aa) aa from g""")
def combined_databases(spark, sf_dir):
    p = T.protein(spark, sf_dir)
    return D.combine([p.where("doc_id % 3 <> 0"), p.where("doc_id % 3 <> 1")], "doc_id", "aa").withColumn("aa", F.md5("aa"))


@_query(T.ctes("protein") + """, s as (select min(doc_id) doc_id, substring(aa, 2) s from protein group by 2)
select doc_id from s a where not exists (select 1 from s b where length(b.s) > length(a.s) and contains(b.s, a.s))""")
def contained_proteins(spark, sf_dir):
    return D.remove_contained(T.protein(spark, sf_dir), "doc_id", "aa", k=24).select("doc_id")


@_query(T.ctes("psms", "protein_sources") + """, g as (select group_id, array_to_string(list_sort(list(distinct source)), '+') sources from psms join protein_sources using (protein_id) group by 1)
select sources, count(*) n from g group by 1""")
def source_counts(spark, sf_dir):
    return I.source_counts(T.psms(spark, sf_dir), T.protein_sources(spark, sf_dir))


@_query(T.ctes("psms", "protein_sources") + """, g as (select group_id, max(substring(bincode, 1, 1)) || max(substring(bincode, 2, 1)) || max(substring(bincode, 3, 1)) bincode from psms join protein_sources using (protein_id) group by 1)
select bincode, count(*) n from g group by 1""")
def bincode_counts(spark, sf_dir):
    return I.bincode_counts(T.psms(spark, sf_dir), T.protein_sources(spark, sf_dir))


@_query(T.ctes("psms") + """, n as (select group_id, protein_id, count(distinct peptide) peptides from psms group by 1, 2), t as (select *, max(peptides) over (partition by group_id) top from n)
select group_id, protein_id, peptides from t where peptides = top""")
def leading_proteins(spark, sf_dir):
    return I.leading_proteins(T.psms(spark, sf_dir))


@_query(T.ctes("psms") + """, p as (select distinct protein_id, peptide from psms where q < 0.02), s as (select protein_id, count(*) n from p group by 1),
x as (select a.protein_id a, b.protein_id b, count(*) n from p a join p b using (peptide) where a.protein_id <> b.protein_id group by 1, 2),
lost as (select distinct x.a from x join s sa on sa.protein_id = x.a join s sb on sb.protein_id = x.b where x.n = sa.n and (sb.n > sa.n or x.b < x.a))
select protein_id, n from s where protein_id not in (select a from lost)""")
def proteins_without_subsets(spark, sf_dir):
    return I.without_subsets(T.psms(spark, sf_dir).where("q < 0.02"))


@_query(T.ctes("psms") + " select group_id, protein_id, peptide from psms where q < 0.05 and pep < 0.05")
def significant_psms(spark, sf_dir):
    return I.significant(T.psms(spark, sf_dir)).select("group_id", "protein_id", "peptide")


@_query(T.ctes("psms") + """, s as (select score, label = 'O' coding from psms), b as (select score, count(*) filter (coding) c, count(*) n from s group by 1)
select score, sum(c) over (order by score desc) / sum(n) over (order by score desc) posterior from b""")
def posteriors(spark, sf_dir):
    return I.posterior(T.psms(spark, sf_dir).selectExpr("score", "label = 'O' coding"))


@_query(T.ctes("psms") + """, s as (select score, label = 'O' p from psms), b as (select score, count(*) filter (p) p, count(*) n from s group by 1),
r as (select *, coalesce(sum(n) over (order by score rows between unbounded preceding and 1 preceding), 0) + (n + 1) / 2 rk from b),
t as (select sum(p) np, sum(n - p) nn, sum(p * rk) s from r) select round((s - np * (np + 1) / 2) / (np * nn), 6) auc from t""")
def auc(spark, sf_dir):
    return I.auc(T.psms(spark, sf_dir).selectExpr("score", "label = 'O' positive"))


@_query(T.ctes("psms") + " select round(quantile_cont(score, 0.95), 6) threshold from psms where label = 'F'")
def translation_threshold(spark, sf_dir):
    return I.threshold(T.psms(spark, sf_dir).where("label = 'F'"))


@_query(T.ctes("psms") + """, a as (select protein_id id, min(q) qa from psms where label = 'O' group by 1), b as (select protein_id id, min(q) qb from psms where label = 'F' group by 1),
j as (select * from a full join b using (id)), t as (select unnest([0.01, 0.02, 0.05])::double t)
select t, count(*) filter (coalesce(qa < t, false) and coalesce(qb < t, false)) kept, count(*) filter (coalesce(qa < t, false) and not coalesce(qb < t, false)) lost, count(*) filter (not coalesce(qa < t, false) and coalesce(qb < t, false)) gained from j cross join t group by 1""")
def gain_loss(spark, sf_dir):
    p = T.psms(spark, sf_dir)
    a, b = (p.where(F.col("label") == x).groupBy(F.col("protein_id").alias("id")).agg(F.min("q").alias("q")) for x in "OF")
    return I.gain_loss(a, b, [0.01, 0.02, 0.05])


@_query(T.ctes("psms") + " select cast(floor(score / 5000.0) as bigint) bin, label, count(*) n from psms group by 1, 2")
def target_decoy_histogram(spark, sf_dir):
    return I.histogram(T.psms(spark, sf_dir), "score", 5000.0)


@_query(T.ctes("psms") + " select label, round(quantile_cont(pep, 0.5), 6) median from psms group by 1")
def pep_medians(spark, sf_dir):
    return I.medians(T.psms(spark, sf_dir), "label", "pep")


@_query(T.ctes("psms") + """, a as (select distinct group_id, peptide, protein_id from psms where label = 'O'), b as (select distinct group_id as other, peptide, protein_id from psms where label = 'F')
select group_id, min(other) other from a join b using (peptide, protein_id) group by 1""")
def engine_overlap(spark, sf_dir):
    p = T.psms(spark, sf_dir)
    return I.overlap(p.where("label = 'O'"), p.where("label = 'F'"))


@_query(T.ctes("variants") + " select chr, pos, ref, alt, dp, af from variants where length(ref) = 1 and length(alt) = 1 and dp between 5 and 40 and (af > 0.95 or (af > 0.3 and af < 0.7))")
def filtered_variants(spark, sf_dir):
    return V.filter_calls(T.variants(spark, sf_dir), (5, 40))


_SETS = {"called": "dp > 20", "known": "af > 0.5", "mismatches": "dp <= 20"}


@_query(T.ctes("variants") + "".join(f", {n} as (select distinct chr, pos, ref, alt from variants where {w})" for n, w in _SETS.items()) + """
select *, 'y' as new from (select * from called except select * from known) union all select *, 'n' from (select * from called intersect select * from known)
union all select *, 'm' from ((select * from mismatches intersect select * from known) except select * from called)""")
def variant_classes(spark, sf_dir):
    v = T.variants(spark, sf_dir)
    return V.classify(*(v.where(w) for w in _SETS.values()))


_VT = T.ctes("variants", "features") + """, d as (select distinct chr, pos, ref, alt from variants),
n as (select feature_id, count(*) n from features f join d on d.chr = f.chr and pos between feature_start and feature_end group by 1)
"""


@_query(_VT + "select f.feature_id, coalesce(n, 0) n from features f left join n using (feature_id)")
def variants_per_transcript(spark, sf_dir):
    return V.per_transcript(T.variants(spark, sf_dir), T.features(spark, sf_dir))


@_query(_VT + """, many as (select f.* from features f join n using (feature_id) where n > 150)
select * from d where not exists (select 1 from many m where m.chr = d.chr and pos between feature_start and feature_end)""")
def variant_guard(spark, sf_dir):
    return V.guard(T.variants(spark, sf_dir), T.features(spark, sf_dir), 150)


@_query(T.ctes("psite") + f""", {_POINTS} select concat('chr', case when chr = 0 then 'M' else chr::varchar end, chr(9), start - 1, chr(9), start, chr(9), case when strand = 1 then cnt else -cnt end) line from points""")
def bedgraph_lines(spark, sf_dir):
    return W.bedgraph(_points(spark, sf_dir).withColumn("chr", F.expr("case when chr = 0 then 'MT' else cast(chr as string) end")).withColumnRenamed("cnt", "count"))


@_query(T.ctes("protein") + """ select doc_id, cast(ntile(5) over (order by doc_id) as integer) part from protein""")
def split_database(spark, sf_dir):
    return W.split_parts(T.protein(spark, sf_dir), 5, "doc_id").select("doc_id", "part")



@_query("with fl as (" + ORACLES["floss_scores"] + """), w as (select row_number() over o as rank, count(*) over r n, avg(nreads) over r mean_reads, quantile_cont(floss, 0.25) over r q1,
quantile_cont(floss, 0.5) over r median, quantile_cont(floss, 0.75) over r q3 from fl window o as (order by nreads, feature_id), r as (order by nreads, feature_id rows between 49 preceding and current row))
select rank, round(mean_reads, 8) mean_reads, round(q1, 8) q1, round(median, 8) median, round(q3, 8) q3, round(q3 + 3 * (q3 - q1), 8) extreme from w where n = 50""")
def rolling_extremes(spark, sf_dir):
    return K.rolling_extreme(floss_scores(spark, sf_dir), width=50)


@_query(T.ctes("psms") + """, b as (select q, count(*) filter (label = 'O') n from psms group by 1), c as (select q, cast(sum(n) over (order by q) as bigint) targets from b)
select q, targets, round(targets * (1 - q), 6) true_positives from c""")
def identification_curve(spark, sf_dir):
    return K.identification_curve(T.psms(spark, sf_dir).withColumn("target", F.col("label") == "O"))


@_query(T.ctes("psms") + """, a as (select distinct protein_id, peptide from psms where label = 'O' and q < 0.05), b as (select distinct protein_id, peptide from psms where label = 'F' and q < 0.05)
select (select count(*) from (select * from a except select * from b)) only_a, (select count(*) from (select * from a intersect select * from b)) overlap,
(select count(*) from (select * from b except select * from a)) only_b""")
def psm_addition(spark, sf_dir):
    kept = T.psms(spark, sf_dir).where("q < 0.05")
    return K.set_overlap(kept.where("label = 'O'"), kept.where("label = 'F'"), ["protein_id", "peptide"])


@_query("with g as (" + ORACLES["frame_metrics"] + """), d as (select spread x, log10(ifc_stat) y from g where spread > 0 and ifc_stat > 0),
m as (select avg(x) mx, avg(y) my from d), s as (select count(*) n, sum(x - mx) s1, sum((x - mx) ** 2) s2, sum((x - mx) ** 3) s3, sum((x - mx) ** 4) s4,
sum((x - mx) * (y - my)) t1, sum((x - mx) ** 2 * (y - my)) t2, sum((y - my) ** 2) vv, max(mx) mx, max(my) my from d cross join m),
f as (select *, (s2 * t2 - s3 * t1) / (s2 * s4 - s2 * s2 * s2 / n - s3 * s3) a from s), h as (select *, (t1 - a * s3) / s2 b from f)
select round(my - a * s2 / n - b * mx + a * mx * mx, 4) c0, round(b - 2 * a * mx, 4) c1, round(a, 4) c2, round((b * t1 + a * t2) / vv, 4) r2 from h""")
def dispersion_fit(spark, sf_dir):
    return K.poly_regression(frame_metrics(spark, sf_dir), "spread", "ifc_stat")


_STARTS = {"aTIS": (1, 0.01), "5UTR": (2, 0.05), "CDS": (2, 0.15), "3UTR": (2, 0.05), "ntr": (2, 0.05)}
_NEAR = "regexp_full_match(substring(seq, {}, 3), '[ACTG]TG|A[ACTG]G|AT[ACTG]')"


@_query(T.ctes("psite", "exons", "dna") + f""", {_CDNA},
hits as (select transcript_id, c.cdna_start + case when p.strand = 1 then p.start - exon_start else exon_end - p.start end cdna, coalesce(sum(cnt) filter (rpf % 2 = 0), 0) ltm, coalesce(sum(cnt) filter (rpf % 2 = 1), 0) chx
 from psite p join cd c on p.chr = c.chr and p.strand = c.strand and p.start between exon_start and exon_end group by 1, 2),
cds as (select transcript_id, 31 a, sum(exon_end - exon_start + 1) - 30 z from exons where transcript_id % 3 <> 0 group by 1 having z > 60),
tot as (select transcript_id, sum(ltm) tl, sum(chx) tc from hits group by 1 having tl > 0),
s as (select h.*, seq, case when {_NEAR.format('cdna::int')} then 0 when cdna > 1 and {_NEAR.format('cdna::int - 1')} then -1 when {_NEAR.format('cdna::int + 1')} then 1 end sh
 from hits h join dna on doc_id = transcript_id where ltm > 0),
p as (select s.transcript_id, s.cdna + sh at_, min(substring(seq, (s.cdna + sh)::int, 3)) codon, string_agg(case sh when 1 then '+1' else sh::varchar end, ' ' order by s.cdna) peak_shift, sum(ltm) cnt, sum(chx) chx from s where sh is not null group by 1, 2),
n as (select p.*, case when a is null then 'ntr' when at_ < a then '5UTR' when at_ = a then 'aTIS' when at_ > z then '3UTR' else 'CDS' end annotation, at_ - a dist, max(cnt) over (partition by transcript_id order by at_ range between 1 preceding and 1 following) top from p left join cds using (transcript_id)),
g as (select n.*, 10 * (cnt * 30.0::double / tl) - case when tc > 0 then 10 * (chx * 30.0::double / tc) else 0 end r, case annotation when 'aTIS' then 1 else 2 end least, case annotation when 'aTIS' then 0.01 when 'CDS' then 0.15 else 0.05 end bar from n join tot using (transcript_id)),
c as (select *, cnt >= least and cnt >= top and r >= bar good from g)
select transcript_id, at_ cdna, annotation, dist::bigint dist_to_atis, codon, peak_shift, cnt::bigint cnt, round(r, 6) r, case when annotation <> 'aTIS' then 'NA' when good then 'True' else 'False' end atis_call from c where good or annotation = 'aTIS'
union all select transcript_id, a, 'aTIS', 0, substring(seq, a, 3), null, null, null, 'no_data' from cds join tot using (transcript_id) left join dna on doc_id = transcript_id where transcript_id not in (select transcript_id from n where annotation = 'aTIS')""")
def start_sites(spark, sf_dir):
    exons = T.exons(spark, sf_dir)
    reads = lambda odd: F.coalesce(F.sum(F.when(F.col("rpf") % 2 == odd, F.col("cnt"))), F.lit(0))
    points = T.psite(spark, sf_dir).groupBy("chr", "strand", "start").agg(reads(0).alias("ltm"), reads(1).alias("chx"))
    sequences = T.dna(spark, sf_dir).withColumnRenamed("doc_id", "transcript_id")
    read = exons.join(sequences.select("transcript_id"), "transcript_id", "left_semi")  # peaks need a sequence, totals do not
    hits = C.exon_hits(points, read).groupBy("transcript_id", "cdna").agg(F.sum("ltm").alias("ltm"), F.sum("chx").alias("chx"))
    totals = J.totals_in(points, exons, "start", "exon_start", "exon_end", {"ltm": F.col("ltm"), "chx": F.col("chx")}, ["transcript_id"])
    cds = exons.where("transcript_id % 3 <> 0").groupBy("transcript_id").agg((F.sum(F.expr("exon_end - exon_start + 1")) - 30).alias("cds_end")).where("cds_end > 60")
    return P.call_starts(hits, sequences, cds.withColumn("cds_start", F.lit(31)), _STARTS, totals=totals)


from ribolith.plans import annotation, assembly  # noqa: E402, F401  register their queries
