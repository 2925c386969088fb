"""The queries of ``queries.py`` as DuckDB SQL over the same views."""

from __future__ import annotations

from contigloom.schemas import OPTIONAL_TOOLS, STAGES, STEPS

_COV = ("coalesce(try_cast(nullif(regexp_extract(header, '_cov_([0-9]+[.]?[0-9]*)', 1), '') as double), "
        "try_cast(nullif(regexp_extract(header, '_depth_([0-9]+[.]?[0-9]*)', 1), '') as double))")
_HIT_SAMPLE = "regexp_replace(regexp_extract(file, '[^/]*$'), '[.](fasta|fa|fna|ffn|faa|fas)$', '')"
_STEP_VALUES = ", ".join(f"({i}, '{s}')" for i, s in enumerate(STEPS))
_OFF = ", ".join(f"'{s}'" for t, steps in OPTIONAL_TOOLS.items() if t != "KRAKEN2" for s in steps)

_FILTERED = f"""measured as (select *, {_COV} as coverage, length(seq) as len from contigs_v),
  flagged as (select *, coalesce(coverage >= 10 and len >= 500, false) as ok from measured),
  marked as (select *, bool_or(ok) over (partition by sample) as any_ok from flagged),
  filtered as (select *, not any_ok as used_fallback from marked where ok or not any_ok)"""

_LATEST = """latest as (select sample, step, status, seq_no from
    (select *, row_number() over (partition by sample, step order by ts desc, seq_no desc) as rn from status_v)
    where rn = 1)"""
_STEPS = f"steps as (select * from (values {_STEP_VALUES}) t(step_no, step))"
_DENSE = f"""{_LATEST}, {_STEPS},
  dense as (select s.sample, t.step, t.step_no, coalesce(l.status, '-') as status
    from (select distinct sample from latest) s cross join steps t
    left join latest l on l.sample = s.sample and l.step = t.step)"""
_KNOWN = "known as (select distinct step from steps join skips_v on upper(name) = upper(step))"
_RECONCILED = f"""{_DENSE}, {_KNOWN},
  reconciled as (select sample, step, step_no, case when step in (select step from known) or step in ({_OFF}) then 'SKIPPED'
    when status = 'SKIPPED' then '-' else status end as status from dense)"""
_LAST = """last as (select sample, arg_max(step, step_no) filter (where status not in ('OK', 'SKIPPED')) as step
    from {t} group by sample)"""

_COMBINED = f"""cells as (select coalesce(nullif({_HIT_SAMPLE}, ''), 'NA') as sample, coalesce(nullif(gene, ''), 'NA') as gene,
    coalesce(nullif(database, ''), 'NA') as database, coalesce(nullif(resistance, ''), 'NA') as resistance from hits_v),
  combined as (select sample as "Sample", database as "Database", string_agg(distinct gene, '; ' order by gene) as "Genes",
    string_agg(distinct resistance, '; ' order by resistance) as "Resistance"
    from cells where sample not in ('abricate', 'before', 'filtered') group by sample, database)"""

_MATE = "'^(.+)[._-]R?([12])(_[0-9]{3})?[.]f(ast)?q([.]gz)?$'"
_READ_FILES = f"""read_files as (select name, regexp_extract(name, {_MATE}, 1) as sample,
    cast(regexp_extract(name, {_MATE}, 2) as int) as mate, concat('/in/', name) as path
  from read_names_v where regexp_matches(name, {_MATE}))"""

_REMOVALS = """removals as (select path, case when rec_no % 11 = 0 and sample <> 'src3' then header end as contig_id
    from contigs_v where sample not in ('src1', 'src2')),
  remaining as (select c.* from contigs_v c where path in (select path from removals)
    and not exists (select 1 from removals r where r.path = c.path and r.contig_id = c.header))"""


def _stats(source: str, keys: str, ref_len: int | None = None) -> str:
    """Assembly statistics, contig by contig."""
    ng50 = "" if ref_len is None else f", max(case when cum * 100 >= {ref_len} * 50 then len end) as ng50"
    thresholds = "".join(f", count(*) filter (where len >= {t}) as contigs_ge_{t}" for t in (1000, 5000, 10000, 25000, 50000))
    return f"""lens as (select {keys}, rec_no, cast(length(seq) as bigint) as len,
      length(seq) - length(replace(replace(seq, 'G', ''), 'C', '')) as gc,
      length(seq) - length(replace(seq, 'N', '')) as unknown from {source}),
    ranked as (select *, sum(len) over (partition by {keys} order by len desc, rec_no rows unbounded preceding) as cum,
      row_number() over (partition by {keys} order by len desc, rec_no) as rn,
      sum(len) over (partition by {keys}) as total from lens),
    stats as (select {keys}, count(*) as n_contigs, cast(max(total) as bigint) as total_length, max(len) as largest,
      max(case when cum * 100 >= total * 50 then len end) as n50, min(case when cum * 100 >= total * 50 then rn end) as l50,
      max(case when cum * 100 >= total * 90 then len end) as n90, min(case when cum * 100 >= total * 90 then rn end) as l90,
      cast(sum(gc) as bigint) as gc_bases, cast(sum(unknown) as bigint) as n_bases{thresholds}{ng50},
      round(sum(gc) * 100 / max(total)::double, 2) as gc_pct, round(sum(unknown) * 100000 / max(total)::double, 2) as n_per_100kbp
      from ranked group by {keys})"""


_STAGES_STATS = f"""{_FILTERED},
  both_stages as (select sample, 'before' as stage, rec_no, seq from contigs_v
    union all select sample, 'after', rec_no, seq from filtered), {_stats('both_stages', 'sample, stage')}"""

_QUAL = "list_transform(range(1, length(qual) + 1), lambda i: ascii(substr(qual, i::int, 1)) - 33)"


def _trimmed(source: str, w: int, q: int, front: bool, tail: bool) -> str:
    """Trimmed reads: good window starts, the first one for the front, the last one for the tail."""
    begin = "good[1]" if front else "1"
    end = f"good[-1] + {w - 1}" if tail else "length(qual)"
    return f"""quals as (select *, {_QUAL} as q from {source}),
    windows as (select *, list_filter(range(1, length(qual) - {w} + 2), lambda i: list_sum(q[i:i + {w - 1}]) >= {w * q}) as good from quals),
    trimmed as (select sample, read_no, mate,
      case when len(good) = 0 then '' else substr(seq, ({begin})::int, ({end} - ({begin}) + 1)::int) end as seq,
      case when len(good) = 0 then '' else substr(qual, ({begin})::int, ({end} - ({begin}) + 1)::int) end as qual
      from windows)"""


def _passed(source: str, q: int, u: int, e: int, l: int) -> str:
    low = "".join(chr(33 + i) for i in range(q)).replace("'", "''")
    mean = "" if e == 0 else f" and list_sum({_QUAL}) >= length(qual) * {e}"
    return f"""judged as (select *, length(qual) >= {l} and (length(qual) - length(translate(qual, '{low}', ''))) * 100 <= length(qual) * {u}{mean} as ok from {source}),
    passed as (select sample, read_no, mate, seq, qual from
      (select *, bool_and(coalesce(ok, false)) over (partition by sample, read_no)
        and min(mate) over (partition by sample, read_no) <> max(mate) over (partition by sample, read_no) as pair_ok from judged) where pair_ok)"""


_LOW20 = "!\"#$%&''()*+,-./01234"
_LOW30 = _LOW20 + "56789:;<=>"
_QC = f"""select sample, mate, stage, count(*) as reads, cast(sum(length(seq)) as bigint) as bases,
    cast(sum(length(translate(qual, '{_LOW20}', ''))) as bigint) as q20_bases,
    cast(sum(length(translate(qual, '{_LOW30}', ''))) as bigint) as q30_bases,
    cast(sum(length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))) as bigint) as gc_bases"""

_K = 11
_CANON = f"least(s, reverse(translate(s, 'ACGT', 'TGCA')))"


def _kmers(source: str, keys: str) -> str:
    return f"""select {keys}, {_CANON} as kmer from (select {keys},
      unnest(list_transform(range(1, length(seq) - {_K - 2}), lambda i: substr(seq, i::int, {_K}))) as s
      from {source} where length(seq) >= {_K}) where not contains(s, 'N')"""


_HITS = f"""kmer_taxa as (select kmer, min(taxid) as taxid from ({_kmers('references_v', 'taxid')}) group by kmer),
  kmer_hits as (select sample, rec_no, taxid, count(*) as n from ({_kmers('contigs_v', 'sample, rec_no')})
    join kmer_taxa using (kmer) group by sample, rec_no, taxid)"""
_CLASSIFIED = f"""{_HITS},
  closure(taxid, ancestor, depth) as (
    select taxid, taxid, 0 from taxonomy_v
    union all select c.taxid, t.parent_taxid, c.depth + 1 from closure c join taxonomy_v t on c.ancestor = t.taxid
      where t.parent_taxid is not null),
  scores as (select h.sample, h.rec_no, h.taxid, sum(a.n) as score from kmer_hits h join closure c on c.taxid = h.taxid
    join kmer_hits a on a.sample = h.sample and a.rec_no = h.rec_no and a.taxid = c.ancestor group by all),
  best as (select *, count(*) over (partition by sample, rec_no) as ties from
    (select *, rank() over (partition by sample, rec_no order by score desc) as r from scores) where r = 1),
  shared as (select b.sample, b.rec_no, c.ancestor, count(*) as m, max(ties) as ties, max(score) as score
    from best b join closure c on c.taxid = b.taxid group by all),
  depths as (select taxid, max(depth) as depth from closure group by taxid),
  found as (select s.sample, s.rec_no, arg_max(s.ancestor, d.depth) as taxid, max(score) as score
    from shared s join depths d on d.taxid = s.ancestor where m = ties group by s.sample, s.rec_no),
  classified as (select c.sample, c.rec_no, c.path, c.header, cast(coalesce(f.taxid, 0) as int) as taxid,
    cast(coalesce(f.score, 0) as bigint) as score from contigs_v c left join found f using (sample, rec_no))"""

_STAGE_ROWS = " union all ".join(
    f"select {stage} as stage, count(distinct sample) filter (where step in ({', '.join(repr(s) for s in steps)}) "
    f"and status not in ('-', 'SKIPPED')) as n_run, count(distinct sample) as n_total from latest"
    for stage, steps in STAGES.items())

_COMPARED = ["n_contigs", "total_length", "largest", "n50", "l50", "n90", "l90", "gc_bases", "n_bases"]
_EXT = "list_value('.fa', '.FASTA', '.fna', '.fas', '.ffn', '.txt')[rec_no % 6 + 1]"
_REPORT_COLUMNS = 'select "Sample", "Database", "Genes", "Resistance" from combined'

ORACLE: dict[str, str] = {
    "scan_contig_files": f"""select concat(sample, '_', rec_no) as sample, concat(sample, '_', rec_no, {_EXT}) as name,
        cast(length(header) + 1 as bigint) as length from contigs_v where rec_no % 6 <> 5 and rec_no % 3 <> 2""",
    "scan_read_files": f"with {_READ_FILES} select sample, mate, name from read_files",
    "read_fasta": f"select sample, header, header as contig_id, {_COV} as coverage, cast(length(seq) as integer) as length, md5(seq) as seq_md5 from contigs_v",
    "read_fastq": "select sample, mate, concat(sample, '.', read_no) as read_id, seq, qual from reads_v",
    "read_removal_list": """select path, header as contig_id from contigs_v where rec_no % 11 = 0
        union all select path, concat('extra_', rec_no) from contigs_v where rec_no % 11 = 0""",
    "read_gene_hits": """select file, gene, database, count(*) as n, cast(sum(pct_identity) as bigint) as identity,
        count(nullif(resistance, '')) as n_resistance from hits_v group by file, gene, database""",
    "read_amr_matrix": """with samples as (select distinct stage, sample from amr_v),
        classes as (select 'F' as stage, unnest(['F_A', 'F_N', 'F_R', 'SHARED']) as drug_class
          union all select 'O', unnest(['O_A', 'O_N', 'O_R', 'SHARED']))
        select case s.stage when 'F' then 'before' else 'after' end as stage, case s.stage when 'F' then 0 else 1 end as file_ord,
          s.sample, c.drug_class, coalesce(a.value, '') as value
        from samples s join classes c using (stage) left join amr_v a on a.stage = s.stage and a.sample = s.sample and a.drug_class = c.drug_class""",
    "read_status": f"with {_DENSE} select sample, step, status from dense",
    "read_tool_reports": f"""with {_STAGES_STATS}, told as (select *, sample || case stage when 'after' then '_filtered' else '' end as genome from stats)
        select 'quast' as tool, sample, stage, unnest(['Assembly|' || sample, '# contigs|' || n_contigs, 'N50|' || n50]) as row from told
        union all select 'checkm2', sample, stage, concat(n_contigs % 90, '.5|', n_contigs % 10, '.0|', n50, '|x') from told
        union all select 'kraken2', sample, stage, unnest(['R|1|' || n_contigs || '|0', 'S|562|' || n50 || '|' || n_contigs]) from told
        union all select 'kraken2_contigs', sample, stage, unnest(['C|c' || n50 || '|562|' || n50, 'U|c2|0|9']) from told
        union all select 'gtdbtk', sample, stage, 'd__B;s__' || n50 from told""",
    "read_step_logs": """select case when line_no % 4 < 2 then file end as sample, unnest(case line_no % 4 when 0 then ['FASTP'] when 1 then ['KRAKEN2-a']
          when 2 then ['GTDBTK-b', 'GTDBTK-a'] else ['MULTIQC'] end) as step, replace(line, chr(10), '\\n') as line from log_lines_v""",
    "write_fasta": f"""with {_FILTERED}
        select concat(sample, '_filtered.fasta') as file, md5(concat('>', header)) as line_md5 from filtered
        union all select concat(sample, '_filtered.fasta'), md5(seq) from filtered""",
    "write_removed_fasta": f"""with {_REMOVALS}
        select concat(sample, '_removed.fasta') as file, md5(concat('>', header)) as line_md5 from remaining
        union all select concat(sample, '_removed.fasta'), md5(seq) from remaining""",
    "write_report_tsv": f"with {_COMBINED} {_REPORT_COLUMNS}",
    "batch_manifest": """with files as (select url as path, regexp_replace(regexp_extract(url, '[^/]*$'), '[.][^.]+$', '') as stem from pages)
        select path as first, stem as second, 'path_stem' as layout from files
        union all select concat(stem, '_before'), path, 'before_path' from files
        union all select stem, path, 'stem_path' from files""",
    "error_digest": f"""with {_LATEST},
        failed as (select sample, step, case when seq_no % 400 % 9 = 0 then concat('no such tool: ', seq_no % 400) else concat('C', seq_no % 400) end as log_path
          from latest where status = 'FAIL'),
        there as (select distinct file from log_lines_v),
        tails as (select * from (select *, row_number() over (partition by file order by line_no desc) as rn from log_lines_v
          where cast(substr(file, 2) as bigint) % 7 <> 0) where rn <= 5)
        select sample, step, line_no, case when t.file is null then log_path else line end as line
        from failed left join tails t on t.file = log_path where t.file is not null or log_path not in (select file from there)""",
    "parse_mate_name": f"with {_READ_FILES} select name, sample, mate from read_files",
    "sample_from_path": """select page_id, regexp_replace(regexp_extract(url, '[^/]*$'), '[.][^.]+$', '') as sample,
        regexp_extract(url, '[^/]*$') as hit_sample from pages""",
    "contig_id": "select rec_no, header as contig_id from contigs_v",
    "coverage_from_header": f"select header, {_COV} as coverage from contigs_v",
    "contig_length": "select rec_no, cast(length(seq) as integer) as length from contigs_v",
    "na_fill": "select coalesce(nullif(resistance, ''), 'NA') as resistance, count(*) as n from hits_v group by 1",
    "stage_tag": f"""select regexp_replace(s, '_filtered$', '') as sample, case when s like '%\\_filtered' escape '\\' then 'after' else 'before' end as stage,
        count(*) as n from (select {_HIT_SAMPLE} as s from hits_v) group by 1, 2""",
    "project_hit_columns": f"with {_COMBINED} select sample, gene, database, resistance from cells",
    "format_duration": """select sample, seconds, format('{:02d}:{:02d}:{:02d}', seconds // 3600, seconds % 3600 // 60, seconds % 60) as duration
        from (select sample, cast(floor(epoch(max(ts))) - floor(epoch(min(ts))) as bigint) as seconds from status_v group by sample)""",
    "filter_min_coverage": f"select sample, header, {_COV} as coverage from contigs_v where {_COV} >= 10",
    "filter_min_length": "select sample, header, cast(length(seq) as integer) as length from contigs_v where length(seq) >= 500",
    "filter_contigs": f"with {_FILTERED} select sample, rec_no, header, md5(seq) as seq_md5, used_fallback from filtered",
    "drop_sentinel_samples": f"""with {_COMBINED} select sample, count(*) as n from cells
        where sample not in ('abricate', 'before', 'filtered') group by sample""",
    "drop_comments": """select file, line_no, case line_no % 4 when 1 then concat(' #', line) else line end as line from log_lines_v
        where line_no % 4 = 1 or line_no % 4 = 3 and trim(line) <> '' and line not like '#%'""",
    "select_steps": """select distinct step from status_v where upper(step) not in (select upper(name) from skips_v)""",
    "filter_hits": "select * from hits_v where pct_identity >= 80 and pct_coverage >= 80",
    "report_search": f"""with {_COMBINED} select "Sample", "Database" from combined
        where contains(lower("Genes"), 'brand#11') and contains(lower("Genes"), 'brand#3') and contains(lower("Database"), 'r')""",
    "report_select": f"""with {_COMBINED} select "Sample", "Database" from combined where "Database" in ('db_A', 'db_N')""",
    "pair_mates": f"""with {_READ_FILES} select sample, max(path) filter (where mate = 1) as r1_path,
        max(path) filter (where mate = 2) as r2_path from read_files group by sample""",
    "missing_mates": f"""with {_READ_FILES} select s.sample, m.mate as missing from (select distinct sample from read_files) s
        cross join (values (1), (2)) m(mate) where not exists (select 1 from read_files r where r.sample = s.sample and r.mate = m.mate)""",
    "remove_contigs": f"with {_REMOVALS} select sample, header, md5(seq) as seq_md5 from remaining",
    "merge_amr_matrices": """with cells as (select sample, drug_class, string_agg(nullif(value, ''), ';' order by stage) as value from amr_v group by 1, 2)
        select sample, """ + ", ".join(f"max(value) filter (where drug_class = '{c}') as \"{c}\""
                                       for c in ("F_A", "F_N", "F_R", "SHARED", "O_A", "O_N", "O_R")) + " from cells group by sample",
    "expand_sample_steps": f"with {_STEPS} select sample, step, '-' as status from (select distinct sample from status_v) cross join steps",
    "reconcile_skips": f"with {_RECONCILED} select sample, step, status from reconciled",
    "compare_before_after": f"with {_STAGES_STATS} select b.sample, " + ", ".join(
        f"b.{c} as {c}_before, a.{c} as {c}_after, a.{c} - b.{c} as {c}_delta" for c in _COMPARED)
        + " from (select * from stats where stage = 'before') b join (select * from stats where stage = 'after') a using (sample)",
    "cohort_report": f"""with {_STAGES_STATS},
        low as (select sample, 'before' as stage, count(*) filter (where {_COV} < 10) as n_low_coverage from contigs_v group by 1),
        found as (select regexp_replace(s, '_filtered$', '') as sample, case when ends_with(s, '_filtered') then 'after' else 'before' end as stage,
          count(*) as n_hits from (select {_HIT_SAMPLE} as s from hits_v) group by 1, 2)
        select sample, stage, n_contigs, n50, n_low_coverage, n_hits from (select sample, stage, n_contigs, n50 from stats)
        full join low using (sample, stage) full join found using (sample, stage)""",
    "screen_kmers": f"with {_HITS} select sample, rec_no, taxid, n from kmer_hits",
    "classify_contigs": f"with recursive {_CLASSIFIED} select sample, rec_no, taxid, score from classified",
    "taxonomy_report": f"""with recursive {_CLASSIFIED},
        totals as (select sample, count(*) as total from classified group by sample),
        rows_ as (select c.sample, k.ancestor as taxid, count(*) filter (where c.taxid = k.ancestor) as direct, count(*) as clade
          from classified c join closure k on k.taxid = c.taxid group by 1, 2
          union all select sample, 0, count(*), count(*) from classified where taxid = 0 group by sample)
        select r.sample, r.taxid, coalesce(t.name, 'unclassified') as name, direct, clade, round(clade * 100 / total::double, 2) as pct
        from rows_ r join totals using (sample) left join taxonomy_v t using (taxid)""",
    "contaminants_to_removals": f"""with recursive {_CLASSIFIED}
        select path, header as contig_id from classified where taxid <> 0
          and taxid not in (select taxid from closure where ancestor = 11)
          and taxid not in (select ancestor from closure where taxid = 11)""",
    "combine_gene_hits": f"with {_COMBINED} {_REPORT_COLUMNS}",
    "stage_progress": f"with {_LATEST} {_STAGE_ROWS}",
    "status_counts": f"with {_LATEST} select step, status, count(*) as n from latest group by step, status",
    "distinct_samples": f"with {_READ_FILES} select distinct sample from read_files",
    "assembly_stats": f"with {_stats('contigs_v', 'sample, stage', 20000)} select * from stats",
    "read_qc_stats": f"""with {_trimmed('reads_v', 4, 27, False, True)}, {_passed('trimmed', 15, 40, 0, 15)},
        both_stages as (select sample, mate, 'before' as stage, seq, qual from reads_v union all select sample, mate, 'after', seq, qual from passed),
        sums as ({_QC} from both_stages group by sample, mate, stage)
        select *, round(q20_bases / nullif(bases, 0)::double, 4) as q20_rate, round(q30_bases / nullif(bases, 0)::double, 4) as q30_rate,
          round(gc_bases / nullif(bases, 0)::double, 4) as gc_rate, round(bases / reads::double, 2) as mean_length from sums""",
    "per_cycle_quality": f"""with cells as (select sample, mate, unnest(range(1, length(seq) + 1)) as pos, seq, qual from reads_v),
        letters as (select sample, mate, cast(pos as int) as pos, substr(seq, pos::int, 1) as b, ascii(substr(qual, pos::int, 1)) - 33 as q from cells),
        sums as (select sample, mate, pos, count(*) as n, cast(sum(q) as bigint) as sum_q, count(*) filter (where b = 'A') as n_a,
          count(*) filter (where b = 'C') as n_c, count(*) filter (where b = 'G') as n_g, count(*) filter (where b = 'T') as n_t,
          count(*) filter (where b not in ('A', 'C', 'G', 'T')) as n_other from letters group by 1, 2, 3)
        select *, round(sum_q / n::double, 4) as mean_q from sums""",
    "hit_summary": """select database, file, gene, string_agg(cast(pct_coverage as varchar), ';' order by pct_coverage desc) as coverages,
        max(n_genes) as n_genes from hits_v join (select database, file, count(distinct gene) as n_genes from hits_v group by 1, 2) using (database, file)
        group by database, file, gene""",
    "facet_values": f"""with {_COMBINED} select distinct 'sample' as "column", sample as value from cells union select 'gene', gene from cells
        union select 'database', database from cells union select 'resistance', resistance from cells""",
    "last_incomplete_step": f"with {_DENSE}, {_LAST.format(t='dense')} select sample, step from last",
    "tail_lines": """select file, line_no, line from (select *, row_number() over (partition by file order by line_no desc) as rn from log_lines_v) where rn <= 5""",
    "pick_contig_file": """with files as (select concat(sample, '_', rec_no // 3) as sample, ['fna', 'fasta', 'ffn', 'FAS', 'fa'][rec_no % 5 + 1] as ext from contigs_v)
        select sample, concat('/in/b/', sample, '.', arg_min(ext, list_position(['fa', 'fas', 'fasta', 'ffn', 'fna'], lower(ext)))) as path from files group by sample""",
    "latest_wins": f"with {_READ_FILES} select concat('S', length(sample)) as sample, mate, max(path) as path from read_files group by 1, 2",
    "length_cumsum": """with counts as (select sample, stage, cast(length(seq) as bigint) as length, count(*) as n from contigs_v group by 1, 2, 3)
        select *, cast(sum(length * n) over w as bigint) as cum_bases, cast(sum(n) over w as bigint) as cum_contigs,
          cast(sum(length * n) over (partition by sample, stage) as bigint) as total_bases
        from counts window w as (partition by sample, stage order by length desc rows unbounded preceding)""",
    "natural_sort": f"""with {_READ_FILES}, names as (select distinct sample, ltrim(substr(sample, 2), '0') as digits from read_files)
        select sample, concat('4|3S2', lpad(cast(length(digits) as varchar), 9, '0'), digits, '1|3S2', lpad(cast(length(digits) as varchar), 9, '0'), digits, '1') as sort_key from names order by cast(substr(sample, 2) as int)""",
    "sort_report": f"""with {_COMBINED} {_REPORT_COLUMNS} order by "Sample", "Database" """,
    "limit_report": f"""with {_COMBINED} {_REPORT_COLUMNS} order by "Sample", "Database" limit 25 offset 25""",
    "union_hits": "select file, database, count(*) as n, cast(sum(pct_identity) as bigint) as identity from hits_v group by 1, 2",
    "union_stage_reports": "select stage, sample, " + ", ".join(
        f"max(value) filter (where drug_class = '{c}') as \"{c}\"" for c in ("F_A", "F_N", "F_R", "SHARED", "O_A", "O_N", "O_R"))
        + " from amr_v group by stage, sample",
    "dedupe_skips": f"with {_STEPS}, {_KNOWN} select step from known",
    "trim_reads": f"with {_trimmed('reads_v', 4, 30, True, True)} select sample, read_no, mate, seq, qual from trimmed",
    "filter_reads": f"with {_passed('reads_v', 20, 31, 25, 40)} select sample, read_no, mate, seq, qual from passed",
    "upsert_status": f"with {_DENSE} select sample as \"Sample\", " + ", ".join(
        f"max(status) filter (where step = '{s}') as \"{s}\"" for s in STEPS) + " from dense group by sample",
    "steps_to_run": f"""with {_RECONCILED}, {_LAST.format(t='reconciled')},
        present as (select concat('/out/', sample, '/', step) as path from status_v where seq_no % 3 <> 0 group by 1 having max(seq_no % 4) > 0)
        select r.sample, r.step, case when r.step in (select step from known) or r.status = 'SKIPPED'
            or (r.step = 'FILTER' and concat('/out/', r.sample, '/SPADES') not in (select path from present)) then 'SKIPPED'
          when l.step = r.step or concat('/out/', r.sample, '/', r.step) not in (select path from present) then 'RUN' else 'KEEP' end as decision
        from reconciled r join last l using (sample)""",
    "stream_status": f"with {_LATEST} select sample, step, status, seq_no from latest",
    "incremental_filter": f"with {_FILTERED} select sample, header, md5(seq) as seq_md5, used_fallback from filtered",
}
