"""Queries over gene models, reads, proteoforms and identifications, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ribolith.functions import sequence as S
from ribolith.operators import counts as C
from ribolith.operators import database as D
from ribolith.operators import genemodel as G
from ribolith.operators import intervals as J
from ribolith.operators import proteoforms as P
from ribolith.operators import quality as Q
from ribolith.plans.registry import query
from ribolith.sources import adapters as T

#: Further inputs, by name: the table and its columns, in words that both engines read alike.
_MADE = {
    "genes": ("part", "p_partkey % 7 = 0", "cast(floor(p_partkey / 7) as bigint) gene_id, concat('G', cast(p_partkey as string)) gene"),
    "transcripts": ("part", "true", "p_partkey transcript_id, cast(floor(p_partkey / 7) as bigint) gene_id, case when p_size % 5 = 0 then 'lincRNA' else 'protein_coding' end biotype"),
    "translations": ("part", "p_size % 5 <> 0", "p_partkey transcript_id, 1 + p_size % 3 seq_start"),
    "xrefs": ("lineitem", "l_partkey % 3 = 0", "l_partkey transcript_id, concat('CCDS', cast(l_suppkey as string)) ccds"),
    "calls": ("part", "true", "p_partkey transcript_id, case when p_size % 4 = 0 then 'No' else 'Yes' end exon_coverage, case when p_partkey % 2 = 0 then 'Yes' else 'No' end canonical, case when p_size % 3 = 0 then 'No' else 'CCDS1' end ccds"),
    "orfs": ("lineitem", "true", """l_orderkey * 10 + l_linenumber orf_id, l_partkey transcript_id, cast(floor(l_partkey / 7) as bigint) gene_id, cast(l_orderkey % 9 as bigint) start, cast(l_suppkey % 5 as bigint) stop,
 case l_linenumber % 5 when 0 then 'aTIS' when 1 then 'CDS' when 2 then '5UTR' when 3 then '3UTR' else 'ntr' end annotation, cast(l_quantity as int) len, l_tax > 0.04 snp, l_discount > 0.05 indel,
 case l_linenumber % 3 when 0 then 'True' when 1 then 'False' else 'no_data' end call"""),
    "frames": ("part", "true", "p_partkey orf_id, p_partkey transcript_id, cast(1 + p_size % 17 as bigint) cdna_from, cast(3 * p_size as bigint) length"),
    "regions": ("lineitem", "true", """l_partkey transcript_id, case when l_partkey % 2 = 0 then 1 else -1 end strand, case when l_linenumber % 3 = 0 then 'UTR' else 'CDS' end feature,
 cast(l_suppkey * 13 as bigint) start, cast(l_suppkey * 13 + l_quantity as bigint) "end\""""),
    "mspsms": ("lineitem", "true", """l_orderkey group_id, l_partkey protein_id, concat('PEP', cast(l_suppkey as string), '_', cast(l_linenumber as string)) peptide, round(l_tax, 4) pep, cast(l_linenumber as int) position"""),
    "scans": ("lineitem", "true", "cast(l_suppkey as string) raw_file, l_orderkey scan, concat('AC', substring('DEFGH', cast(l_linenumber % 5 as int) + 1, 1)) peptide, l_partkey protein_id"),
    "sequences": ("part", "true", "p_partkey protein_id, case when p_size % 3 = 0 then 'MKACDLL' when p_size % 3 = 1 then 'MACEACFK' else 'MGGACGACHACD' end seq"),
    "pairs": ("lineitem", "true", """l_orderkey * 10 + l_linenumber id, case l_linenumber when 1 then 'MKLACDEF' when 2 then '---ACDEF' when 3 then 'MKLACD--' when 4 then 'MKIACDEF' when 5 then 'MKLAQQEF' when 6 then 'MKL--DEF' else 'WWLAYDEW' end a,
 case when l_linenumber = 1 and l_suppkey % 2 = 0 then '---ACDEF' when l_linenumber = 7 and l_suppkey % 2 = 0 then 'MKLACDEF' else 'MKLACDEF' end b,
 case when l_suppkey % 7 = 0 then 'ntr' when l_suppkey % 7 = 1 then '5UTR' when l_suppkey % 7 = 2 then '3UTR' else 'CDS' end annotation"""),
    "tracks": ("lineitem", "true", "l_returnflag sample, l_partkey transcript_id, cast(l_quantity as bigint) cnt"),
    "mdreads": ("lineitem", "true", """cast(l_suppkey % 20 as bigint) chr, cast((l_partkey * 37) % 5000 as bigint) pos, case when l_linenumber % 3 = 0 then '10M' when l_linenumber % 3 = 1 then '4M100N6M' else '2S8M' end cigar,
 case when l_linenumber % 3 = 2 then '3A4' when l_suppkey % 2 = 0 then '4C5' else '10' end md, case when l_suppkey % 3 = 0 then 'GGACGTTGCA' else 'GGACTTTGCA' end seq"""),
}


def _made(spark, sf_dir, name):
    source, where, columns = _MADE[name]
    view = T.table(spark, sf_dir, source)
    return spark.sql(f"select {columns.replace(chr(34), '`')} from {{t}} where {where}", t=view)


def _with(*names: str) -> str:
    rows = [f"{n} as (select {_MADE[n][2]} from {_MADE[n][0]} where {_MADE[n][1]})" if n in _MADE else T.CTE[n] for n in names]
    return "with " + ",\n".join(rows) + "\n"


def _hits(spark, sf_dir):
    return C.exon_hits(C.merged(T.psite(spark, sf_dir)), T.exons(spark, sf_dir))


_POINTS = "points as (select chr, strand, start, cast(sum(cnt) as bigint) cnt from psite group by 1, 2, 3)"
_CDNA = "cd as (select *, cast(coalesce(sum(exon_end - exon_start + 1) over (partition by transcript_id order by rank rows between unbounded preceding and 1 preceding), 0) + 1 as bigint) cdna_start from exons)"
_HIT = f"""{_POINTS}, {_CDNA}, hit as (select p.cnt, transcript_id, c.cdna_start + case when p.strand = 1 then p.start - exon_start else exon_end - p.start end cdna
 from points p join cd c on p.chr = c.chr and p.strand = c.strand and p.start between exon_start and exon_end), size_ as (select transcript_id, cast(sum(exon_end - exon_start + 1) as bigint) length from exons group by 1)"""


def _sizes(spark, sf_dir):
    return T.exons(spark, sf_dir).groupBy("transcript_id").agg(F.sum(F.expr("exon_end - exon_start + 1")).alias("length"))


@query(_with("genes", "transcripts", "translations") + "select transcript_id, gene_id, gene, biotype, seq_start from transcripts join genes using (gene_id) join translations using (transcript_id)")
def coding_transcripts(spark, sf_dir):
    rows = G.coding_transcripts(*(_made(spark, sf_dir, n) for n in ("genes", "transcripts", "translations")))
    return rows.select("transcript_id", "gene_id", "gene", "biotype", "seq_start")


@query(_with("transcripts", "translations") + "select transcript_id, biotype from transcripts where transcript_id not in (select transcript_id from translations)")
def noncoding_transcripts(spark, sf_dir):
    return G.noncoding_transcripts(_made(spark, sf_dir, "transcripts"), _made(spark, sf_dir, "translations")).select("transcript_id", "biotype")


@query(_with("transcripts", "xrefs") + "select transcript_id, coalesce(c, 'No') ccds from transcripts left join (select transcript_id, min(ccds) c from xrefs group by 1) using (transcript_id)")
def consensus_transcripts(spark, sf_dir):
    return G.with_ccds(_made(spark, sf_dir, "transcripts"), _made(spark, sf_dir, "xrefs")).select("transcript_id", "ccds")


@query(_with("calls") + "select transcript_id from calls where exon_coverage = 'Yes' and canonical = 'Yes'")
def canonical_calls(spark, sf_dir):
    return G.transcript_filter(_made(spark, sf_dir, "calls"), "canonical").select("transcript_id")


@query(_with("orfs", "xrefs") + "select orf_id, m external from orfs left join (select transcript_id, min(ccds) m from xrefs group by 1) using (transcript_id)")
def mapped_orfs(spark, sf_dir):
    mapping = _made(spark, sf_dir, "xrefs").groupBy("transcript_id").agg(F.min("ccds").alias("external"))
    return G.canonical_map(_made(spark, sf_dir, "orfs"), mapping).select("orf_id", "external")


@query(_with("exons", "frames") + f""", {_CDNA}, p as (select o.orf_id, rank, strand, exon_start, exon_end, greatest(cdna_start, cdna_from) lo, least(cdna_start + exon_end - exon_start, cdna_from + length - 1) hi, cdna_start from cd join frames o using (transcript_id)),
c as (select orf_id, rank, strand, case when strand = 1 then exon_start + lo - cdna_start else exon_end - (hi - cdna_start) end a, case when strand = 1 then exon_start + hi - cdna_start else exon_end - (lo - cdna_start) end z from p where lo <= hi)
select orf_id, cast(arg_max(case when strand = 1 then z else a end, rank) as bigint) stop, string_agg(cast(a as varchar), '_' order by rank) starts, string_agg(cast(z as varchar), '_' order by rank) ends from c group by 1""")
def orf_structures(spark, sf_dir):
    return G.orf_structure(_made(spark, sf_dir, "frames"), T.exons(spark, sf_dir))


@query(_with("exons", "variants") + f""", {_CDNA} select c.transcript_id, v.chr, v.pos, cast(cdna_start + case when strand = 1 then pos - exon_start else exon_end - pos end as bigint) tr_pos,
case when strand = 1 then ref else translate(ref, 'ACGT', 'TGCA') end ref, case when strand = 1 then alt else translate(alt, 'ACGT', 'TGCA') end alt, af from variants v join cd c on v.chr = c.chr and pos between exon_start and exon_end""")
def variants_in_exons(spark, sf_dir):
    return G.variants_in_exons(T.variants(spark, sf_dir), T.exons(spark, sf_dir))


@query(_with("regions") + """, c as (select transcript_id, min(start) cs from regions where feature = 'CDS' group by 1),
r as (select *, case when feature = 'CDS' then 'CDS' when (start < cs) = (strand = 1) then '5UTR' else '3UTR' end region from regions join c using (transcript_id))
select transcript_id, region, min(start) as first, max("end") as last, cast(sum("end" - start + 1) as bigint) bases from r group by 1, 2""")
def transcript_regions(spark, sf_dir):
    return G.transcript_regions(_made(spark, sf_dir, "regions"))


@query(T.ctes("psite", "features") + f""", {_POINTS}, w as (select *, case when strand = 1 then feature_start - 1000 else feature_end - 200 end a, case when strand = 1 then feature_start + 200 else feature_end + 1000 end z from features)
select feature_id, cast(sum(cnt) as bigint) counts_sum, count(*) counts_n from points p join w on p.chr = w.chr and p.strand = w.strand and p.start between a and z group by 1""")
def promoter_counts(spark, sf_dir):
    windows = G.feature_window(T.features(spark, sf_dir)).selectExpr("feature_id", "chr", "strand", "window_start feature_start", "window_end feature_end")
    return C.feature_counts(C.merged(T.psite(spark, sf_dir)), windows)


@query(_with("orfs") + "select orf_id from orfs where len >= 10 and call not in ('no_data', 'False')")
def long_orfs(spark, sf_dir):
    return D.long_enough(_made(spark, sf_dir, "orfs")).select("orf_id")


@query(_with("orfs") + """, k as (select distinct gene_id, start from orfs where annotation = 'aTIS')
select orf_id from orfs o where annotation = 'aTIS' or snp or indel or not exists (select 1 from k where k.gene_id = o.gene_id and k.start = o.start)""")
def orfs_without_redundant_starts(spark, sf_dir):
    orfs = _made(spark, sf_dir, "orfs").selectExpr("orf_id", "gene_id gene", "start", "annotation = 'aTIS' annotated", "snp or indel has_variant")
    return D.drop_redundant_starts(orfs).select("orf_id")


def _unique_orfs(spark, sf_dir):
    return _made(spark, sf_dir, "orfs").groupBy("orf_id").agg(*(F.min(c).alias(c) for c in ("transcript_id", "start", "stop")))


_ORDER = {
    "best_representatives": "len desc, (indel and snp) desc, indel desc, snp desc, orf_id",
    "base_orfs": "(annotation = 'aTIS') desc, len desc, (indel or snp), orf_id",
    "base_proteoforms": "case annotation when 'aTIS' then 0 when 'CDS' then 1 when '5UTR' then 2 when '3UTR' then 3 when 'ntr' then 4 else 5 end, orf_id",
}


def _chosen(name):
    return _with("orfs") + f"select transcript_id, start, orf_id from (select *, row_number() over (partition by transcript_id, start order by {_ORDER[name]}) r from orfs) where r = 1"


@query(_chosen("best_representatives"))
def best_representatives(spark, sf_dir):
    return G.best_representative(_made(spark, sf_dir, "orfs"), ["transcript_id", "start"]).select("transcript_id", "start", "orf_id")


@query(_chosen("base_orfs"))
def base_orfs(spark, sf_dir):
    return G.base_orf(_made(spark, sf_dir, "orfs"), ["transcript_id", "start"]).select("transcript_id", "start", "orf_id")


@query(_chosen("base_proteoforms"))
def base_proteoforms(spark, sf_dir):
    return G.base_proteoform(_made(spark, sf_dir, "orfs"), ["transcript_id", "start"]).select("transcript_id", "start", "orf_id")


@query(_with("orfs") + """, orfs_ as (select orf_id, min(transcript_id) transcript_id, bool_and(snp) snp, bool_and(indel) indel from orfs group by 1)
select orf_id, cast(row_number() over (partition by transcript_id order by snp::int + indel::int, cast(floor(orf_id / 30) as bigint), orf_id) as integer) number, cast(dense_rank() over (partition by transcript_id order by snp::int + indel::int) as integer) "order",
case when count(*) over (partition by cast(floor(orf_id / 30) as bigint)) > 1 then cast(cast(floor(orf_id / 30) as bigint) as varchar) || '_' || cast(row_number() over (partition by cast(floor(orf_id / 30) as bigint) order by orf_id) as varchar) else cast(cast(floor(orf_id / 30) as bigint) as varchar) end as name from orfs_""")
def proteoform_numbers(spark, sf_dir):
    rows = _made(spark, sf_dir, "orfs").groupBy("orf_id").agg(F.min("transcript_id").alias("transcript_id"), F.bool_and("snp").alias("snp"), F.bool_and("indel").alias("indel"))
    rows = rows.selectExpr("orf_id snp_id", "transcript_id structure", "cast(snp as int) + cast(indel as int) variants", "cast(floor(orf_id / 30) as bigint) orf_id")
    return P.variant_numbers(rows).selectExpr("snp_id orf_id", "number", "order", "name")


@query(_with("orfs") + """, u as (select orf_id, min(transcript_id) transcript_id, min(start) start, min(stop) stop from orfs group by 1), e as (select a.orf_id a, b.orf_id b from u a join u b on a.transcript_id = b.transcript_id and (a.start = b.start or a.stop = b.stop))
select a orf_id, count(*) linked from e group by 1""")
def structure_links(spark, sf_dir):
    orfs = _unique_orfs(spark, sf_dir)
    count = lambda by: orfs.groupBy("transcript_id", *by).agg(F.count("*").alias("n_" + "_".join(by)))
    rows = orfs.join(count(["start"]), ["transcript_id", "start"]).join(count(["stop"]), ["transcript_id", "stop"]).join(count(["start", "stop"]), ["transcript_id", "start", "stop"])
    return rows.selectExpr("orf_id", "n_start + n_stop - n_start_stop linked")


_STRUCTURES = _with("orfs").replace("with ", "with recursive ", 1) + """, u as (select orf_id, min(transcript_id) transcript_id, min(start) start, min(stop) stop, min(annotation) annotation from orfs group by 1),
reach as (select orf_id, orf_id root from u union select b.orf_id, r.root from reach r join u a on a.orf_id = r.orf_id join u b on a.transcript_id = b.transcript_id and (a.start = b.start or a.stop = b.stop)),
found as (select orf_id, min(root) structure from reach group by 1) """


@query(_STRUCTURES + "select u.orf_id, u.transcript_id, u.start, u.stop, structure from u join found using (orf_id)")
def structure_groups(spark, sf_dir):
    return G.structure_groups(_unique_orfs(spark, sf_dir))


@query(_STRUCTURES + """, g as (select transcript_id, structure, max(cast(annotation = 'aTIS' as int)) annotated, count(*) members from u join found using (orf_id) group by 1, 2)
select transcript_id, structure, members, cast(row_number() over (partition by transcript_id order by annotated desc, structure) as int) number from g""")
def structure_numbers(spark, sf_dir):
    orfs = _made(spark, sf_dir, "orfs").groupBy("orf_id").agg(*(F.min(c).alias(c) for c in ("transcript_id", "start", "stop", "annotation")))
    return G.structure_order(G.structure_groups(orfs))


@query(_with("psite", "exons", "dna") + f""", {_HIT}, t as (select x.transcript_id, d.seq from (select distinct transcript_id from exons) x join dna d on d.doc_id = x.transcript_id),
c as (select substring(seq, cast(cdna - (cdna - 1) % 3 as integer), 3) codon, cast((cdna - 1) % 3 as integer) phase, cast(sum(cnt) as bigint) reads from hit join t using (transcript_id) group by 1, 2)
select codon, phase, reads, round(100 * reads / (sum(reads) over ()), 6) percent from c where length(codon) = 3""")
def codon_usage(spark, sf_dir):
    seqs = T.dna(spark, sf_dir).select(F.col("doc_id").alias("transcript_id"), "seq")
    exons = T.exons(spark, sf_dir).join(seqs.select("transcript_id"), "transcript_id", "left_semi")  # others have no codons
    hits = C.exon_hits(C.merged(T.psite(spark, sf_dir)), exons)
    return Q.codon_phase_counts(hits, exons.select("transcript_id").distinct().join(seqs, "transcript_id"))


@query(_with("psite", "exons") + f""", {_HIT}, s as (select transcript_id, sum(cnt) reads, max(cnt) top from hit group by 1),
r as (select transcript_id, coalesce(reads, 0) > 0 covered, coalesce(top / reads <= 0.5, false) even, length >= 50 long from size_ left join s using (transcript_id))
select *, covered and even and long passes from r""")
def coverage_checks(spark, sf_dir):
    return Q.coverage_checks(_hits(spark, sf_dir), _sizes(spark, sf_dir))


_READS = """r as (select chr, case when flag & 16 != 0 then -1 else 1 end strand, pos, cigar, list_sum(list_transform(list_filter(regexp_extract_all(cigar, '\\d+[A-Z]'), lambda x: right(x, 1) in ('M', 'I')), lambda x: cast(x[:-2] as bigint))) len,
 list_sum(list_transform(list_filter(regexp_extract_all(cigar, '\\d+[A-Z]'), lambda x: right(x, 1) in ('M', 'D', 'N')), lambda x: cast(x[:-2] as bigint))) span from alignments),
e as (select chr, strand, cast(len as integer) len, cast(case when strand = 1 then pos else pos + span - 1 end as bigint) as first from r)"""


@query(_with("alignments") + f", {_READS}" + """, s as (select chr, strand, first, len, count(*) n from e group by 1, 2, 3, 4),
p as (select chr, strand, cast(first + strand * floor(len / 2) as bigint) start, n p, 0 a from s union all select chr, strand, cast(first + strand * (floor(len / 2) + 3) as bigint), 0, n from s)
select chr, strand, start, cast(sum(p) as bigint) p_reads, cast(sum(a) as bigint) a_reads from p group by 1, 2, 3""")
def site_coverage(spark, sf_dir):
    return Q.site_coverage(Q.read_ends(T.alignments(spark, sf_dir)))


@query(_with("alignments", "features") + f", {_READS}" + """, s as (select distinct chr, strand, feature_start start from features), n as (select e.len, o off, count(*) n from e, unnest(range(cast(ceil(e.len * 0.4) as bigint), cast(floor(e.len * 0.6) as bigint) + 1)) u(o)
 where exists (select 1 from s where s.chr = e.chr and s.strand = e.strand and s.start = e.first + e.strand * o) group by 1, 2), b as (select len, arg_min(off, (-n, off)) best from n group by 1)
select l.len, cast(coalesce(best, floor(l.len / 2)) as bigint) "offset" from (select distinct len from e) l left join b using (len)""")
def psite_offsets(spark, sf_dir):
    starts = T.features(spark, sf_dir).selectExpr("chr", "strand", "feature_start start")
    return Q.psite_offsets(Q.read_ends(T.alignments(spark, sf_dir)), starts)


@query(_with("alignments") + f", {_READS}" + " select round(sum(len - 24) / count(*), 6) mean_length from e where len > 24")
def mean_pruned_length(spark, sf_dir):
    return Q.mean_pruned_length(Q.read_ends(T.alignments(spark, sf_dir)))


@query("""with o as (select p_size length, max(case when p_partkey % 3 = 0 then 50 else 10 + p_size % 5 end) as off from part group by 1), k as (select *, nullif(off, 50) x from o)
select length, cast(coalesce(last_value(x ignore nulls) over (order by length rows between unbounded preceding and current row), min(x) over ()) as integer) "offset" from k""")
def filled_offsets(spark, sf_dir):
    rows = T.table(spark, sf_dir, "part").groupBy(F.col("p_size").alias("length")).agg(F.max(F.expr("case when p_partkey % 3 = 0 then 50 else 10 + p_size % 5 end")).alias("offset"))
    return Q.offset_fill(rows)


@query(_with("alignments") + f", {_READS}" + """ select chr, cast(case when r.strand = 1 then r.pos + 12 else r.pos + r.span - 12 end as bigint) rna_pos, count(*) cnt from r where cigar not like '%N%' group by 1, 2""")
def rna_positions(spark, sf_dir):
    rows = Q.read_ends(T.alignments(spark, sf_dir)).where("cigar not like '%N%'")
    span = F.abs(F.col("first") - F.col("pos")) + 1
    span = F.when(F.col("strand") == 1, F.lit(0)).otherwise(span)
    return rows.groupBy("chr", Q.rna_position(F.col("pos"), F.col("strand"), span, F.col("len"), F.lit(12)).cast("long").alias("rna_pos")).agg(F.count("*").alias("cnt"))


@query(_with("psite", "exons") + f""", {_CDNA}, h as (select transcript_id, rpf, cast(sum(cnt) as bigint) n from psite p join cd c on p.chr = c.chr and p.strand = c.strand and p.start between exon_start and exon_end group by 1, 2),
f as (select *, n / sum(n) over (partition by transcript_id) f from h) select rpf, round(sum(f) / (select count(distinct transcript_id) from h), 6) ref from f group by 1""")
def reference_distribution(spark, sf_dir):
    sums = C.length_sums(T.psite(spark, sf_dir), T.exons(spark, sf_dir), "transcript_id", "exon_start", "exon_end")
    return Q.reference_distribution(sums.withColumnRenamed("reads", "cnt"))


@query(_with("tracks") + """, s as (select sample, sum(cnt) z from tracks group by 1), f as (select sample, z / (select min(z) from s) f from s)
select sample, transcript_id, round(c / f, 6) normalized from (select sample, transcript_id, sum(cnt) c from tracks group by 1, 2) join f using (sample)""")
def normalized_tracks(spark, sf_dir):
    tracks = _made(spark, sf_dir, "tracks").groupBy("sample", "transcript_id").agg(F.sum("cnt").alias("cnt"))
    return Q.library_normalize(tracks).select("sample", "transcript_id", "normalized")


@query(_with("tracks") + "select transcript_id, cast(sum(case when sample = 'A' then cnt else 0 end) as bigint) \"A\", cast(sum(case when sample = 'N' then cnt else 0 end) as bigint) \"N\", cast(sum(case when sample = 'R' then cnt else 0 end) as bigint) \"R\" from tracks group by 1")
def sample_counts(spark, sf_dir):
    return Q.sample_counts(_made(spark, sf_dir, "tracks"), ["A", "N", "R"])


@query(_with("mdreads") + """, k as (select *, case when md = '3A4' then 3 when md = '4C5' then 4 end off0, case when md = '3A4' then 'A' when md = '4C5' then 'C' end ref from mdreads),
m as (select chr, cast(pos + off0 + case when cigar = '4M100N6M' and off0 >= 4 then 100 else 0 end as bigint) pos, ref, substring(seq, off0 + 1 + case when cigar = '2S8M' then 2 else 0 end, 1) alt from k where off0 is not null)
select chr, pos, ref, alt, count(*) n from m where ref <> alt group by 1, 2, 3, 4""")
def md_mismatches(spark, sf_dir):
    return Q.md_mismatches(_made(spark, sf_dir, "mdreads")).groupBy("chr", "pos", "ref", "alt").agg(F.count("*").alias("n"))


@query(_with("mdreads") + """, k as (select *, case when md = '3A4' then 3 when md = '4C5' then 4 end off0, case when md = '3A4' then 'A' when md = '4C5' then 'C' end ref from mdreads),
m as (select chr, cast(pos + off0 + case when cigar = '4M100N6M' and off0 >= 4 then 100 else 0 end as bigint) pos, ref, substring(seq, off0 + 1 + case when cigar = '2S8M' then 2 else 0 end, 1) alt from k where off0 is not null),
s as (select chr, pos, ref, alt, count(*) alts from m where ref <> alt group by 1, 2, 3, 4),
b as (select chr, pos a, pos + case cigar when '10M' then 9 when '4M100N6M' then 3 else 7 end z from mdreads union all select chr, pos + 104, pos + 109 from mdreads where cigar = '4M100N6M'),
d as (select x.chr, x.pos, count(*) dp from (select distinct chr, pos from s) x join b on b.chr = x.chr and x.pos between a and z group by 1, 2)
select chr, pos, ref, alt, alts, dp, round(alts / dp, 6) af from s join d using (chr, pos)""")
def pileup_frequencies(spark, sf_dir):
    reads = _made(spark, sf_dir, "mdreads")
    return Q.allele_frequency(reads, Q.md_mismatches(reads))


def _floss(spark, sf_dir):
    psite, features = T.psite(spark, sf_dir), T.features(spark, sf_dir)
    return C.floss(psite, features, C.reference_fractions(psite, features))


@query("""with s as (select p_partkey feature_id, nullif(cast(p_size as bigint), 7) nreads, round(p_retailprice / 2000, 6) floss from part), c as (select distinct cast(p_size as bigint) nreads, 0.5 + p_size % 10 / 100.0 cutoff from part where p_size between 10 and 40)
select feature_id, case when coalesce(s.nreads, 0) = 0 then 'No reads' when cutoff is null then 'Not in cutoff range' when floss < cutoff then 'Good' else 'Extreme' end as class from s left join c using (nreads)""")
def floss_classes(spark, sf_dir):
    part = T.table(spark, sf_dir, "part")
    scores = part.selectExpr("p_partkey feature_id", "nullif(cast(p_size as bigint), 7) nreads", "round(p_retailprice / 2000, 6) floss")
    return Q.floss_classes(scores, part.where("p_size between 10 and 40").selectExpr("cast(p_size as bigint) nreads", "0.5D + p_size % 10 / 100.0D cutoff").distinct()).select("feature_id", "class")


@query()
def coherence_scores(spark, sf_dir):
    return Q.coherence(Q.profiles(_hits(spark, sf_dir), _sizes(spark, sf_dir)))


@query(_with("pairs") + ", q as (select id, min(struct_pack(a := a, b := b)) p from pairs group by 1), u as (select id, p.a a, p.b b from q) select id, case when b like '-%' then '' when a = 'MKIACDEF' then '3|I' when a = 'WWLAYDEW' then '5|Y;8|W' else '' end simple, case when b like '-%' then '0|0|MKL' when a = '---ACDEF' then '1|3|' when a = 'MKLACD--' then '7|8|' when a = 'MKLAQQEF' then '5|6|QQ' when a = 'MKL--DEF' then '4|5|' when a = 'WWLAYDEW' then '1|2|WW' else '' end complex from u")
def variant_descriptions(spark, sf_dir):
    return P.variant_descriptions(_made(spark, sf_dir, "pairs").groupBy("id").agg(F.min(F.struct("a", "b")).alias("p")).select("id", "p.a", "p.b"))


@query(_with("pairs") + """select id, case when annotation = 'ntr' then 'Translation of non-coding region' when annotation = '5UTR' then 'uORF' when annotation = '3UTR' then 'dORF' when b like '-%' then 'N-terminal extension' when a = b then 'Canonical' when a = '---ACDEF' then 'N-terminal truncation' when a = 'MKLACD--' then 'C-terminal truncation' when a in ('MKIACDEF', 'MKLAQQEF', 'WWLAYDEW') then 'Only amino acid substitutions' else 'Exon exclusion' end as class from pairs""")
def proteoform_classes(spark, sf_dir):
    return _made(spark, sf_dir, "pairs").select("id", P.classify_pair(F.col("a"), F.col("b"), F.col("annotation")).alias("class"))


@query(_with("pairs") + """select case when b like '-%' then 'N-terminal extension' when a = b then 'canonical form' when a = '---ACDEF' then 'N-terminal truncation' when a = 'MKLACD--' then 'C-terminal truncation' when a = 'MKIACDEF' then 'SAV' when a = 'MKLAQQEF' then 'other variation' when a = 'WWLAYDEW' then 'SAV, other variation' else 'other variation' end as name, count(*) n from pairs group by 1""")
def proteoform_names(spark, sf_dir):
    return _made(spark, sf_dir, "pairs").groupBy(P.proteoform_name(F.col("a"), F.col("b")).alias("name")).agg(F.count("*").alias("n"))


@query(_with("pairs") + "select case when annotation in ('ntr', '5UTR', '3UTR') then 'other' when a = b then 'same' else 'changed' end as class, count(*) n from pairs group by 1")
def classification_counts(spark, sf_dir):
    rows = _made(spark, sf_dir, "pairs").selectExpr("case when annotation in ('ntr', '5UTR', '3UTR') then 'other' when a = b then 'same' else 'changed' end class")
    return P.classification_counts(rows)


@query(_with("orfs") + """, s as (select cast(floor(orf_id / 20) as bigint) structure, min(gene_id) gene, bool_or(annotation = 'aTIS') a, bool_and(annotation = 'ntr') n, bool_and(annotation = 'CDS') c from orfs group by 1)
select structure, gene, case when a then 'Gene product of ' when n then 'Product from non-coding part of ' when c then 'Alternative reading frame product of ' else 'Undeterminable product of ' end || cast(gene as varchar) as name from s""")
def protein_names(spark, sf_dir):
    return P.protein_names(_made(spark, sf_dir, "orfs").selectExpr("cast(floor(orf_id / 20) as bigint) structure", "gene_id gene", "annotation"))


@query(_with("mspsms") + """, g as (select group_id, list_sort(list(distinct {'peptide': peptide, 'pep': pep})) l from mspsms group by 1)
select group_id, array_to_string(list_transform(l, lambda x: x.peptide), '|') peptides, array_to_string(list_transform(l, lambda x: cast(x.pep as varchar)), '|') peps from g""")
def group_identifications(spark, sf_dir):
    rows = _made(spark, sf_dir, "mspsms").withColumn("peptide_id", F.concat_ws("/", F.col("peptide"), F.col("pep").cast("string")))
    return P.identifications(rows.groupBy("group_id").agg(F.collect_set("peptide_id").alias("peptide_ids")), rows.select("peptide_id", "peptide", "pep").distinct())


@query(_with("mspsms") + """, b as (select peptide, protein_id from mspsms where position % 2 = 0), m as (select distinct a.group_id from mspsms a join b using (peptide, protein_id) where a.position % 2 = 1),
s as (select group_id, max(length(peptide)) longest, min(pep) pep from mspsms where position % 2 = 1 group by 1)
select group_id, case when group_id in (select group_id from m) then 'overlap' when longest > 7 then 'long' when pep < 0.01 then 'strong' else 'alone' end as class from s""")
def engine_comparison(spark, sf_dir):
    rows = _made(spark, sf_dir, "mspsms")
    return P.compare_engines(rows.where("position % 2 = 1"), rows.where("position % 2 = 0"), longest=7)


@query(_with("mspsms") + """, o as (select distinct group_id, protein_id, peptide from mspsms), s as (select distinct group_id, protein_id partner, peptide from mspsms where position = 2),
u as (select * from o union select o.group_id, o.protein_id, s.peptide from (select distinct group_id, protein_id from o) o join s on s.group_id = o.group_id and s.partner in (o.protein_id + 1, o.protein_id + 2))
select group_id, protein_id, count(distinct peptide) peptides from u group by 1, 2""")
def corrected_peptide_counts(spark, sf_dir):
    rows = _made(spark, sf_dir, "mspsms")
    redundant = rows.select("protein_id").distinct().withColumn("partner", F.explode(F.array(F.expr("protein_id + 1"), F.expr("protein_id + 2"))))
    return P.corrected_peptide_counts(rows, redundant)


@query(_with("mspsms") + """, o as (select distinct group_id, protein_id, peptide from mspsms), k as (select distinct peptide from mspsms where protein_id % 5 = 0), b as (select distinct protein_id, peptide from mspsms where pep > 0.04),
u as (select *, 1 tier from o where peptide not in (select peptide from k) union all select *, 2 from o where not exists (select 1 from b where b.protein_id = o.protein_id and b.peptide = o.peptide)),
t as (select *, min(tier) over (partition by group_id, protein_id) least from u) select group_id, protein_id, tier, count(distinct peptide) peptides from t where tier = least group by 1, 2, 3""")
def proving_peptides(spark, sf_dir):
    rows = _made(spark, sf_dir, "mspsms")
    own = rows.select("group_id", "protein_id", "peptide").distinct()
    return P.proving_peptides(own, own.select("protein_id", "peptide").distinct(), rows.where("protein_id % 5 = 0"), rows.where("pep > 0.04").select("protein_id", "peptide").distinct())


@query(_with("scans", "sequences") + """, p as (select distinct raw_file, scan, peptide from scans), r as (select * from scans where protein_id % 4 <> 0),
m as (select p.raw_file, p.scan, p.peptide, case when contains(seq, p.peptide) then cast(r.protein_id as varchar) end x from p left join r using (raw_file, scan, peptide) left join sequences s on s.protein_id = r.protein_id)
select raw_file, scan, peptide, coalesce(array_to_string(list_sort(list(distinct x) filter (x is not null)), ';'), 'NoProteinInfoFound') proteins from m group by 1, 2, 3""")
def scan_proteins(spark, sf_dir):
    rows = _made(spark, sf_dir, "scans")
    return P.scan_proteins(rows.select("raw_file", "scan", "peptide").distinct(), rows.where("protein_id % 4 <> 0"), _made(spark, sf_dir, "sequences"))


@query(_with("orfs") + """, c as (select gene_id, min(orf_id) base from orfs where annotation = 'aTIS' group by 1)
select orf_id, case when annotation = 'ntr' then 'non-coding' else coalesce(cast(base as varchar), 'unknown') end base from orfs left join c using (gene_id)""")
def base_canonicals(spark, sf_dir):
    orfs = _made(spark, sf_dir, "orfs")
    return P.base_canonical(orfs, orfs.where("annotation = 'aTIS'").selectExpr("gene_id", "orf_id protein_id")).select("orf_id", "base")


@query("""select concat_ws('_', cast(l_suppkey as varchar), cast(l_orderkey as varchar), cast(l_linenumber as varchar), case when l_linenumber % 2 = 0 then 'ACMK' else 'PEPTIDE' end) as key, count(*) n from lineitem group by 1""")
def psm_keys(spark, sf_dir):
    seq = F.expr("case when l_linenumber % 2 = 0 then 'K.AC[+57.02]M(ox)K.R' else '-.PEPT[80]IDE.G' end")
    rows = T.table(spark, sf_dir, "lineitem").select(P.psm_key(F.col("l_suppkey").cast("string"), F.col("l_orderkey"), F.col("l_linenumber"), seq).alias("key"))
    return rows.groupBy("key").agg(F.count("*").alias("n"))


@query(_with("mspsms") + """, g as (select group_id, list_sort(list(distinct cast(protein_id as varchar))) l from mspsms group by 1) select group_id, array_to_string(l, chr(9)) proteins from g""")
def pin_rows(spark, sf_dir):
    rows = _made(spark, sf_dir, "mspsms").groupBy("group_id").agg(F.array_sort(F.collect_set(F.col("protein_id").cast("string"))).alias("proteins"))
    return P.pin_columns(rows, ["group_id"])


@query(_with("mspsms") + """, m as (select group_id, case when protein_id % 50 = 0 then 'CON__' else '' end || cast(protein_id as varchar) protein from mspsms)
select group_id, count(*) n from m where group_id not in (select group_id from m where protein like 'CON%') group by 1""")
def uncontaminated_groups(spark, sf_dir):
    rows = _made(spark, sf_dir, "mspsms").selectExpr("group_id", "concat(case when protein_id % 50 = 0 then 'CON__' else '' end, cast(protein_id as string)) protein")
    return P.without_contaminated(rows).groupBy("group_id").agg(F.count("*").alias("n"))


@query(_with("sequences") + """, p as (select cast(protein_id as varchar) id, seq from sequences union all select 'CON__' || cast(protein_id as varchar), seq from sequences where protein_id % 10 = 0)
select id, seq from p union all select 'REV__' || id, array_to_string(list_reverse(regexp_extract_all(seq, '([KR]*[^KR]|[KR]+$)')), '') from p""")
def search_database(spark, sf_dir):
    rows = _made(spark, sf_dir, "sequences").selectExpr("cast(protein_id as string) id", "seq")
    return P.with_decoys(rows, rows.where("cast(id as bigint) % 10 = 0"), S.decoy(F.col("seq")))


@query(_with("mspsms") + """, p as (select group_id, list(distinct case when protein_id % 9 = 0 then 'sp' || protein_id else 'ENST' || protein_id end) l from mspsms group by 1)
select group_id from p where len(list_filter(l, lambda x: x not like 'ENST%')) = 0""")
def custom_peptides(spark, sf_dir):
    name = F.expr("concat(case when protein_id % 9 = 0 then 'sp' else 'ENST' end, cast(protein_id as string))")
    return P.custom_peptides(_made(spark, sf_dir, "mspsms").groupBy("group_id").agg(F.collect_set(name).alias("proteins"))).select("group_id")


@query(_with("orfs") + """, o as (select orf_id, case when len % 4 = 0 then 'CTG' else 'ATG' end codon, 'ATG' called, case when len % 3 = 0 then 'MK*' when len % 3 = 1 then 'M*K*' else 'MKL' end aa from orfs)
select orf_id, codon = called and aa = 'MK*' as valid from o""")
def checked_orfs(spark, sf_dir):
    rows = _made(spark, sf_dir, "orfs").selectExpr("orf_id", "case when len % 4 = 0 then 'CTG' else 'ATG' end codon", "'ATG' called_codon", "case when len % 3 = 0 then 'MK*' when len % 3 = 1 then 'M*K*' else 'MKL' end aa")
    good, bad = P.valid_orfs(rows)
    return good.select("orf_id", F.lit(True).alias("valid")).unionByName(bad.select("orf_id", F.lit(False).alias("valid")))


@query("""select lpad(bin(i), 3, '0') bincode, array_to_string(list_filter([case when (i >> 2) & 1 = 1 then 'a' end, case when (i >> 1) & 1 = 1 then 'b' end, case when i & 1 = 1 then 'c' end], lambda x: x is not null), '+') as label, n from (select 1 + p_size % 7 i, count(*) n from part group by 1)""")
def bincode_label_counts(spark, sf_dir):
    rows = T.table(spark, sf_dir, "part").groupBy(F.expr("lpad(bin(1 + p_size % 7), 3, '0')").alias("bincode")).agg(F.count("*").alias("n"))
    return rows.join(F.broadcast(P.bincode_labels(spark, ["a", "b", "c"])), "bincode").select("bincode", "label", "n")


@query(_with("dna") + """, s as (select transcript_id, n, d.seq from (select p_partkey transcript_id, 20 * p_size n from part) p left join dna d on d.doc_id = p.transcript_id)
select transcript_id, length(seq) seq_length, coalesce(length(seq) = n, false) fits from s""")
def sequence_lengths(spark, sf_dir):
    seqs = T.dna(spark, sf_dir).select(F.col("doc_id").alias("transcript_id"), "seq")
    rows = P.missing_lengths(T.table(spark, sf_dir, "part").selectExpr("p_partkey transcript_id", "20 * p_size length"), seqs)
    return rows.select("transcript_id", F.col("seq_length").cast("long").alias("seq_length"), "fits")


@query(_with("exons") + f""", {_CDNA}, g as (select transcript_id, rank, unnest([cdna_start, cdna_start + exon_end - exon_start]) cdna, * exclude (transcript_id, rank, cdna_start), cdna_start from cd)
select transcript_id, cast(rank as integer) as rank, cast(cdna as bigint) cdna, cast(case when strand = 1 then exon_start + cdna - cdna_start else exon_end - (cdna - cdna_start) end as bigint) position from g""")
def genome_positions(spark, sf_dir):
    rows = J.with_cdna(T.exons(spark, sf_dir)).withColumn("cdna", F.explode(F.array("cdna_start", "cdna_end")))
    return rows.select("transcript_id", "rank", "cdna", J.genome_position().alias("position"))


@query("select p_partkey feature_id, greatest(case when p_size % 2 = 0 then (p_partkey * 53) % 100000 - 50 else (p_partkey * 53) % 100000 end, case when p_size % 2 = 0 then 1 else 0 end) utr_start, case when p_size % 2 = 0 then 0 else 50 end + (p_partkey * 53) % 100000 + 20 * p_size utr_end from part")
def upstream_regions(spark, sf_dir):
    return J.upstream(T.features(spark, sf_dir), "feature_start", "feature_end").select("feature_id", "utr_start", "utr_end")
