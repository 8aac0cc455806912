"""SQL of the registered queries, written apart from the Spark jobs, for a single-node engine on the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Formats and the split pattern, as in the jobs.
SYSTEM_V1 = "'Below is an instruction that describes a task. Write a response that completes the request.' || chr(10) || chr(10)"
SYSTEM_V2 = "'Below is an instruction that describes a task. Write a response that completes the request. ' || chr(10) || chr(10)"
INSTRUCTION = "'###Instruction:' || chr(10)"
RESPONSE = "chr(10) || chr(10) || '###Response:' || chr(10)"
EOS = "'<|endoftext|>'"
PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def cut(text: str) -> str:
    """Pieces of a text: EOS splits it first, then the pattern splits the parts."""
    pieces = f"regexp_extract_all(part, '{PATTERN}', 0)"
    return f"""flatten(list_transform(string_split({text}, {EOS}),
        lambda part, nr: case when nr = 1 then {pieces} else list_prepend({EOS}, {pieces}) end))"""


def text(ids: str) -> str:
    return f"array_to_string({ids}, ',')"


def fill(value: str, n: str) -> str:
    return f"list_transform(range({n}), lambda _i: {value})"


def r4(value: str) -> str:
    return f"round({value}, 4) + 0.0"


# Named parts; a query takes the ones it needs, and each part names the parts that it reads.
PARTS: dict[str, tuple[list[str], str]] = {
    "pairs": (
        [],
        """select conv_id || '-' || turn as pair_id, text as instruction, reply as response
           from (select *, lead(role) over w as next_role, lead(text) over w as reply
                 from conversations window w as (partition by conv_id order by turn))
           where role = 'user' and next_role = 'assistant'""",
    ),
    "doc_pairs": (
        [],
        """select doc_id as pair_id, case when cut > 0 then substr(text, 1, cut - 1) else text end as instruction,
                  case when cut > 0 then substr(text, cut + 1) else '' end as response
           from (select doc_id, coalesce(text, '') as text, instr(coalesce(text, ''), chr(10)) as cut from documents)""",
    ),
    "formatted": (
        ["pairs"],
        f"""select pair_id, {SYSTEM_V1} || {INSTRUCTION} || instruction || {RESPONSE} || response || {EOS} as text_v1,
                   {SYSTEM_V2} || {INSTRUCTION} || instruction || {RESPONSE} || response || {EOS} as text_v2
            from pairs""",
    ),
    "tokens": (["formatted"], f"select pair_id, text_v2, {cut('text_v2')} as tokens from formatted"),
    "counted": (["tokens"], "select token, count(*) as n from (select unnest(tokens) as token from tokens) group by token"),
    "ranked": (
        ["counted"],
        """select token, (row_number() over (order by n desc, token) - 1)::integer as id, n from counted
           where token not in ('<|endoftext|>', '[UNK]', '[PAD]') order by n desc, token limit 50000""",
    ),
    "top_vocab": (
        ["ranked"],
        """select token, id, n, false as special from ranked where id < 8192
           union all
           select s.token, (size + s.nr)::integer, 0, true from (select count(*) as size from ranked where id < 8192),
             (values ('[UNK]', 0), ('<|endoftext|>', 1), ('[PAD]', 2)) s(token, nr)""",
    ),
    "vocab": (
        ["ranked"],
        """select token, id, n, false as special from ranked
           union all
           select s.token, (size + s.nr)::integer, 0, true from (select count(*) as size from ranked),
             (values ('[UNK]', 0), ('<|endoftext|>', 1), ('[PAD]', 2)) s(token, nr)""",
    ),
    "sp": (
        ["vocab"],
        """select max(id) filter (token = '[UNK]') as unk, max(id) filter (token = '<|endoftext|>') as eos,
                  max(id) filter (token = '[PAD]') as pad, count(*) as size from vocab""",
    ),
    "encoded": (
        ["tokens", "vocab", "sp"],
        """select pair_id, list(coalesce(v.id, sp.unk) order by nr) as ids
           from (select pair_id, unnest(tokens) as token, generate_subscripts(tokens, 1) as nr from tokens)
           left join vocab v using (token), sp group by pair_id""",
    ),
    "prepared": (
        ["encoded", "tokens"],
        f"""select pair_id, len(ids)::integer as n_tokens, ids,
                   case when instr(text_v2, '###Response:' || chr(10)) > 0
                        then len({cut("substr(text_v2, 1, instr(text_v2, '###Response:' || chr(10)) + 12)")}) else 0
                   end::integer as n_prompt
            from encoded join tokens using (pair_id) where len(ids) < 1024""",
    ),
    "splits": (
        ["prepared"],
        """select pair_id, n_tokens, case when p < ceil(0.2 * n) then 'test' else 'train' end as split
           from (select *, row_number() over (order by md5('42|split|' || pair_id)[:16], pair_id) - 1 as p,
                        count(*) over () as n from prepared)""",
    ),
    "placed": (
        ["splits"],
        """select split, epoch::integer as epoch, pair_id, n_tokens, count(*) over (partition by split, epoch) as n,
                  row_number() over (partition by split, epoch
                                     order by md5('42|' || epoch || '|' || split || '|' || pair_id)[:16], pair_id) - 1 as p
           from splits, range(3) e(epoch)""",
    ),
    "plan": (
        ["placed"],
        """select split, epoch, pair_id, n_tokens, p, rank, batch, slot,
                  max(n_tokens) over (partition by split, epoch, rank, batch) as width
           from (select *, (p % 4)::integer as rank, (p // 4) // 8 as batch, ((p // 4) % 8)::integer as slot
                 from placed where p < n // 4 * 4)""",
    ),
    "plan_single": (
        ["placed"],
        """select split, epoch, pair_id, n_tokens, p, 0 as rank, batch, slot,
                  max(n_tokens) over (partition by split, epoch, batch) as width
           from (select *, p // 8 as batch, (p % 8)::integer as slot
                 from placed where split = 'test' or p < n // 8 * 8)""",
    ),
    "padded": (
        ["plan", "prepared", "sp"],
        f"""select split, epoch, rank, batch, slot, pair_id, n_prompt, sp.pad,
                   list_concat(ids, {fill("sp.pad", "width - len(ids)")}) as ids
            from plan join prepared using (pair_id), sp""",
    ),
    "prefs": (
        ["pairs"],
        """select a.p, a.pair_id, a.instruction as prompt, a.response as chosen, b.response as rejected
           from ordered a join ordered b on b.p = (a.p + 1) % a.n""",
    ),
    "ordered": (
        ["pairs"],
        """select *, count(*) over () as n, row_number() over (order by md5('42|0|' || pair_id)[:16], pair_id) - 1 as p
           from pairs""",
    ),
    "pref_pieces": (
        ["prefs"],
        f"""select p, pair_id, 'prompt' as part, {cut("prompt")} as tokens from prefs
            union all select p, pair_id, 'chosen', list_append({cut("chosen")}, {EOS}) from prefs
            union all select p, pair_id, 'rejected', list_append({cut("rejected")}, {EOS}) from prefs""",
    ),
    "pref_ids": (
        ["pref_pieces", "vocab", "sp"],
        """select p, pair_id, part, list(coalesce(v.id, sp.unk) order by nr) as ids
           from (select p, pair_id, part, unnest(tokens) as token, generate_subscripts(tokens, 1) as nr from pref_pieces)
           left join vocab v using (token), sp group by all""",
    ),
    "pref_rows": (
        ["pref_ids"],
        f"""select p // 8 as batch, p, pair_id, c.part as side, q.ids as prompt_ids, c.ids as completion_ids,
                   list_concat(q.ids, c.ids) as ids,
                   list_concat({fill("0", "len(q.ids)")}, {fill("1", "len(c.ids)")}) as loss_mask
            from pref_ids c join pref_ids q using (p, pair_id) where c.part <> 'prompt' and q.part = 'prompt'""",
    ),
    "policy_counts": (
        ["pairs"],
        f"select token, count(*) as n from (select unnest({cut('response')}) as token from pairs) group by token",
    ),
    "reference_counts": (
        [],
        f"""select token, count(*) as n from (select unnest({cut("coalesce(text, '')")}) as token from documents)
            group by token""",
    ),
    "scores": (
        ["policy_counts", "reference_counts"],
        """select token, ln((p.n + 1) / pm) as policy, ln((coalesce(r.n, 0) + 1) / rm) as reference
           from policy_counts p left join reference_counts r using (token),
             (select sum(n) + count(*) as pm from policy_counts), (select sum(n) + count(*) as rm from reference_counts)""",
    ),
    "score_rows": (
        ["prefs", "scores"],
        f"""select p, pair_id, side, nr, policy, reference from (
              select p, pair_id, side, unnest(tokens) as token, generate_subscripts(tokens, 1) as nr from (
                select p, pair_id, 'chosen' as side, {cut("chosen")} as tokens from prefs
                union all select p, pair_id, 'rejected', {cut("rejected")} from prefs)
            ) join scores using (token)""",
    ),
    "score_sums": (
        ["score_rows"],
        """select p, pair_id, count(*) filter (side = 'chosen') as chosen_length,
                  count(*) filter (side = 'rejected') as rejected_length,
                  sum(policy) filter (side = 'chosen') as pc, sum(policy) filter (side = 'rejected') as pr,
                  sum(reference) filter (side = 'chosen') as rc, sum(reference) filter (side = 'rejected') as rr
           from score_rows group by p, pair_id""",
    ),
    "logits": (
        [],
        """select vec_id as request_id, label as label_id, generate_subscripts(embedding, 1)::integer - 1 as token_id,
                  unnest(embedding)::double as value from embeddings""",
    ),
    "place_scores": (
        ["logits"],
        """select scale, request_id, max(label_id) as label_id,
                  max(scale * value) filter (token_id = label_id) - (max(top) + ln(sum(exp(scale * value - top)))) as logp,
                  ln(sum(exp(2 * (scale * value - top)))) - 2 * ln(sum(exp(scale * value - top))) as lse2,
                  sum(scale * value) as logit_sum, count(*) as logit_count
           from (select *, max(scale * value) over (partition by scale, request_id) as top
                 from logits, (values (10.0::double), (8.0::double)) s(scale))
           group by scale, request_id""",
    ),
    "places": (
        ["place_scores"],
        """select *, case when masked then logp else 0.0 end as mlogp from (
             select *, pos between case side when 0 then pair_id % 2 else 1 - pair_id % 2 end
                           and case side when 0 then 4 - pair_id % 3 else 3 + pair_id % 2 end as masked
             from (select *, request_id // 10 as pair_id, request_id % 2 as side, (request_id % 10) // 2 as pos
                   from place_scores))""",
    ),
    "place_sums": (
        ["places"],
        """select scale, pair_id, side, coalesce(sum(logp) filter (pos < 4), 0) as logp, count(*) as length,
                  coalesce(sum(-logp) filter (label_id <> 0 and pos < 4), 0) as nll_sum,
                  count(*) filter (label_id <> 0 and pos < 4) as nll_count,
                  coalesce(sum(-logp) filter (label_id <> 0), 0) as nll_sum_all, count(*) filter (label_id <> 0) as nll_count_all,
                  sum(logit_sum) as logit_sum, sum(logit_count) as logit_count, sum(before - lse2) as weight_sum
           from (select *, coalesce(lag(mlogp) over (partition by scale, pair_id, side order by pos),
                                    max_by(mlogp, pos) over (partition by scale, pair_id, side)) as before
                 from places) where masked group by scale, pair_id, side""",
    ),
    "logit_pairs": (
        ["place_sums"],
        """select c.pair_id, c.pair_id // 8 as batch, c.length as chosen_length, c.logp as pc, r.logp as pr,
                  rc.logp as rc, rr.logp as rr, 0.1 * ((c.logp - r.logp) - (rc.logp - rr.logp)) + 0.4 * (c.length - r.length) as x,
                  c.nll_sum, c.nll_count, c.logit_sum as chosen_logits, c.logit_count as chosen_count,
                  r.logit_sum as rejected_logits, r.logit_count as rejected_count,
                  least(exp(c.weight_sum / c.length + r.weight_sum / r.length), 1) as weight
           from place_sums c join place_sums r on r.pair_id = c.pair_id and r.side = 1 and r.scale = 10
             join place_sums rc on rc.pair_id = c.pair_id and rc.side = 0 and rc.scale = 8
             join place_sums rr on rr.pair_id = c.pair_id and rr.side = 1 and rr.scale = 8
           where c.side = 0 and c.scale = 10""",
    ),
    "logit_losses": (
        ["logit_pairs"],
        """select *, greatest(-x, 0) + ln(1 + exp(-abs(x))) as loss,
                  sum(nll_sum) over (partition by batch) / sum(nll_count) over (partition by batch) as nll
           from logit_pairs""",
    ),
    "steps": (
        [],
        """select user_id as run_id, row_number() over (partition by user_id order by ts, event_id) as global_step,
                  case event_type when 'view' then 'forward' when 'click' then 'backward'
                    when 'purchase' then 'build_batch' when 'signup' then 'optimizer_step' end as phase,
                  value as elapsed_s, event_type <> 'error' as ok, value as loss from events""",
    ),
    "phase_steps": (
        ["steps"],
        """select run_id, (global_step - 1) // 4 + 1 as global_step,
                  ['forward', 'backward', 'build_batch', 'optimizer_step'][(global_step - 1) % 4 + 1] as phase,
                  elapsed_s, ok, case when (global_step - 1) % 4 = 0 then loss end as loss from steps""",
    ),
}


def sql(parts: str, select: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for needed in PARTS[name][0] + (["ordered"] if name == "prefs" else []):
            add(needed)
        order.append(name)

    for name in parts.split():
        add(name)
    # A part that reads itself is recursive and cannot be materialised.
    heads = ",\n".join(f"{name} as {'' if f'from {name} ' in PARTS[name][1] else 'materialized '}({PARTS[name][1]})" for name in order)
    return f"with recursive {heads}\n{select}" if heads else select


def merge_parts(merges: int) -> None:
    """Words as bracketed bytes, and one best pair after the other merged in all of them."""
    PARTS["bpe_words_0"] = (
        ["counted"],
        f"select token, n, regexp_replace(hex(encode(token)), '(..)', '<\\1>', 'g') as word from counted where token <> {EOS}",
    )
    PARTS["bpe_known_0"] = ([], "select '' as piece where false")
    for k in range(merges):
        PARTS[f"bpe_best_{k}"] = (
            [f"bpe_words_{k}", f"bpe_known_{k}"],
            f"""select p[1] as l, p[2] as r, p[1] || p[2] as piece, sum(n)::bigint as n
                from (select n, unnest(list_zip(s[:-2], s[2:])) as p
                      from (select n, string_split(word[2:-2], '><') as s from bpe_words_{k}) where len(s) > 1)
                where p[1] || p[2] not in (select piece from bpe_known_{k})
                group by all having sum(n) >= 2 order by n desc, l, r limit 1""",
        )
        PARTS[f"bpe_words_{k + 1}"] = (
            [f"bpe_best_{k}"],
            f"""select token, w.n, coalesce(replace(word, '<' || l || '><' || r || '>', '<' || piece || '>'), word) as word
                from bpe_words_{k} w left join bpe_best_{k} on true""",
        )
        PARTS[f"bpe_known_{k + 1}"] = ([f"bpe_best_{k}"], f"select piece from bpe_known_{k} union all select piece from bpe_best_{k}")
    every = " union all ".join(f"select {k} as rank, * from bpe_best_{k}" for k in range(merges))
    PARTS["bpe_merged"] = ([f"bpe_best_{k}" for k in range(merges)], f'select rank, l as "left", r as "right", piece, n from ({every})')
    PARTS["bpe_ids"] = (
        ["tokens", "bpe_merged", f"bpe_words_{merges}"],
        f"""select pair_id, place, nr, case when token = {EOS} then 256 + (select count(*) from bpe_merged)
                   when m.piece is not null then 256 + m.rank else ('0x' || p.piece)::integer end as id
            from (select pair_id, unnest(tokens) as token, generate_subscripts(tokens, 1) as place from tokens)
            left join (select token, unnest(s) as piece, generate_subscripts(s, 1) as nr
                       from (select token, string_split(word[2:-2], '><') as s from bpe_words_{merges})) p using (token)
            left join bpe_merged m on m.piece = p.piece""",
    )


merge_parts(48)


def oracle(name: str, parts: str, select: str) -> None:
    ORACLE[name] = sql(parts, select)


# -- instruction rows -----------------------------------------------------------------------------------------------

oracle("sft_pairs", "pairs", "select * from pairs")
oracle("sft_format", "formatted", "select * from formatted")
oracle(
    "source_formats",
    "pairs",
    "select format, pair_id, instruction, response from pairs, (values ('csv'), ('json'), ('orc')) f(format)",
)
oracle(
    "sft_prompt",
    "pairs",
    f"select pair_id as prompt_id, {SYSTEM_V1} || {INSTRUCTION} || instruction || {RESPONSE} as prompt from pairs",
)
oracle(
    "token_stats",
    "tokens",
    """select count(*) as pairs, sum(len(tokens))::bigint as tokens, min(len(tokens)) as min_tokens,
              max(len(tokens)) as max_tokens, count(*) filter (len(tokens) < 256) as within_context from tokens""",
)
oracle("token_counts", "counted", "select * from counted")
oracle("vocab_top", "top_vocab", "select * from top_vocab")
oracle("vocab_all", "vocab", "select * from vocab")
oracle(
    "vocab_specials",
    "sp",
    "select unk as unk_id, eos as eos_id, pad as pad_id, -100 as ignore_id, size as vocab_size from sp",
)
oracle("vocab_user_table", "vocab", "select token, id, true as pad_added, false as pad_added_again from vocab")
for name in ("encode_ids", "encode_ids_joined"):
    oracle(name, "encoded", f"select pair_id, len(ids) as n_tokens, {text('ids')} as ids from encoded")
oracle(
    "decode_text",
    "prepared vocab",
    """select pair_id, string_agg(token, '' order by nr) as text,
              string_agg(case when special then '' else token end, '' order by nr) as plain_text
       from (select pair_id, unnest(ids) as id, generate_subscripts(ids, 1) as nr from prepared) join vocab using (id)
       group by pair_id""",
)
oracle("bpe_merges", "bpe_merged", "select * from bpe_merged")
oracle(
    "bpe_encode",
    "bpe_ids",
    f"""select pair_id, count(*) as n_pieces, string_agg(id::varchar, ',' order by place, nr) as ids from bpe_ids group by pair_id""",
)
oracle(
    "bpe_decode",
    "tokens",
    f"""select pair_id, array_to_string(tokens, '') as text,
               array_to_string(list_filter(tokens, lambda t: t <> {EOS}), '') as plain_text from tokens""",
)
oracle("context_filter", "tokens", "select pair_id, len(tokens) as n_tokens from tokens where len(tokens) < 256")
oracle(
    "context_filter_docs",
    "doc_pairs",
    f"""select pair_id, n_tokens from (select pair_id,
          len({cut(f"{SYSTEM_V2} || {INSTRUCTION} || instruction || {RESPONSE} || response || {EOS}")}) as n_tokens
        from doc_pairs) where n_tokens < 1024""",
)
oracle("prompt_length", "prepared", "select pair_id, n_tokens, n_prompt from prepared")

# -- split, epochs, shards ------------------------------------------------------------------------------------------

oracle("split", "splits", "select pair_id, split from splits")
oracle("split_sizes", "splits", "select split, count(*) as rows from splits group by split")
oracle("epoch_plan", "plan", "select * from plan")
oracle("epoch_plan_single", "plan_single", "select * from plan_single")
oracle(
    "shard_report",
    "plan splits",
    """select split, rank, handled, rows from
         (select split, rank, count(*) as handled from plan where epoch = 0 group by split, rank)
         join (select split, count(*) as rows from splits group by split) using (split)""",
)
oracle(
    "batch_counts",
    "plan plan_single splits",
    """select split, rows, batches_per_rank, batches_single from
         (select split, count(*) as rows from splits group by split)
         join (select split, count(distinct batch) as batches_per_rank from plan where rank = 0 and epoch = 0 group by split)
           using (split)
         join (select split, count(distinct batch) as batches_single from plan_single where epoch = 0 group by split)
           using (split)""",
)
oracle(
    "resume_plan",
    "plan",
    """select epoch, rank, batch, slot, pair_id from plan
       where split = 'train' and (epoch > 1 or (epoch = 1 and batch >= 2))""",
)

oracle(
    "shard_resume",
    "plan prepared",
    f"""select epoch, rank, batch, slot, pair_id, {text("ids")} as input_ids from plan join prepared using (pair_id)
        where split = 'train' and (epoch > 1 or (epoch = 1 and batch >= 2))""",
)

# -- epoch order by arithmetic --------------------------------------------------------------------------------------


def keyed(part: int) -> str:
    """28 bits of a hash of seed, epoch, split, round and part."""
    return f"('0x' || substr(md5('42|' || epoch || '|' || split || '|' || round || '|{part}'), 1, 7))::bigint"


PARTS["numbered"] = (
    ["splits", "prepared"],
    """select split, pair_id, len(ids) as n_tokens, row_number() over (partition by split order by pair_id) - 1 as i,
              count(*) over (partition by split) as n from splits join prepared using (pair_id)""",
)
PARTS["round_keys"] = (
    ["numbered"],
    f"""select split, epoch, n, a, (n + a - 1) // a as b, x, y, z from
          (select *, floor(sqrt(n - 1))::bigint + 1 as a from (select distinct split, n from numbered) where n > 1
           union all select *, 1 from (select distinct split, n from numbered) where n = 1),
          (select split as s, epoch, list(kx order by round) as x, list(ky order by round) as y, list(kz order by round) as z
           from (select split, epoch, round, {keyed(0)} as kx, {keyed(1)} + 1 as ky, {keyed(2)} as kz
                 from (values ('train'), ('test')) s(split), range(3) e(epoch), range(8) r(round)) group by all) k
        where s = split""",
)


def rounds(source: str) -> str:
    """``source`` with place ``p`` moved on by eight rounds over its halves."""
    inner = f"(select *, p // b as l, p % b as r from {source})"
    for k in range(1, 9):
        half, other, size = ("l", "r", "a") if k % 2 else ("r", "l", "b")
        inner = f"(select * replace (({half} + (({other} + x[{k}]) * y[{k}] + z[{k}]) % 2147483647) % {size} as {half}) from {inner})"
    return f"select split, epoch, n, a, b, x, y, z, pair_id, n_tokens, l * b + r as p from {inner}"


PARTS["walks"] = (
    ["numbered", "round_keys"],
    f"""{rounds("(select m.split, epoch, m.n, a, b, x, y, z, pair_id, n_tokens, i as p from numbered m join round_keys k using (split))")}
        union all {rounds("(select * from walks where p >= n)")}""",
)
PARTS["permuted"] = (
    ["walks"],
    """select split, epoch::integer as epoch, pair_id, n_tokens::integer as n_tokens, p, (p % 4)::integer as rank, p // 4 // 8 as batch, (p // 4 % 8)::integer as slot
       from walks where p < n // 4 * 4""",
)
oracle("epoch_order", "permuted", "select * from permuted")
oracle("rank_slots", "permuted", "select batch, slot, pair_id from permuted where split = 'train' and epoch = 2 and rank = 1 and batch >= 1")

# -- batches --------------------------------------------------------------------------------------------------------

KEY = "split, epoch, rank, batch"


def labels(shift: bool, mask: bool) -> str:
    ids = "ids[2:]" if shift else "ids"
    masked = f"list_transform({ids}, lambda x, i: case when i <= n_prompt then -100 else x end)" if mask else ids
    inputs = "ids[1:len(ids) - 1]" if shift else "ids"
    return f"""select {KEY}, slot, pair_id, inputs,
        case when len(list_filter(labels, lambda x: x = pad)) > 1
             then list_transform(labels, lambda x: case when x = pad then -100 else x end) else labels end as labels
        from (select *, {inputs} as inputs, {masked} as labels from padded)"""


def collated(shift: bool, mask: bool) -> str:
    return f"""select {KEY}, slot, pair_id, {text("inputs")} as inputs, {text("labels")} as labels
               from ({labels(shift, mask)})"""


oracle("collate_plain", "padded", collated(False, False))
oracle("collate_shift", "padded", collated(True, False))
oracle("collate_masked", "padded", collated(False, True))
oracle("collate_masked_shift", "padded", collated(True, True))
oracle(
    "collate_batches",
    "padded",
    f"""select {KEY}, string_agg({text("inputs")}, ';' order by slot) as inputs,
               string_agg({text("labels")}, ';' order by slot) as labels
        from ({labels(False, True)}) group by {KEY}""",
)
oracle(
    "collate_user_function",
    "padded",
    f"""select {KEY}, count(*) as rows, max(len(inputs)) as width,
               sum(len(list_filter(labels, lambda x: x <> -100)))::bigint as counted_labels
        from ({labels(False, True)}) group by {KEY}""",
)


ORACLE["collate_user_stream"] = ORACLE["collate_user_function"]


def spoken(ids: str) -> str:
    """Text of an id list, by way of a list of all tokens in id order."""
    return f"array_to_string(list_transform({ids}, lambda x: words[x + 1]), '')"


oracle(
    "sample_report",
    "padded vocab",
    f"""select rank, pair_id, {text("inputs")} as inputs, {text("labels")} as labels, {spoken("inputs")} as input_text,
               {spoken("list_transform(labels, lambda x: case when x = -100 then len(words) - 1 else x end)")} as label_text
        from ({labels(False, True)}), (select list(token order by id) as words from vocab)
        where split = 'train' and epoch = 0 and batch = 0 and slot = 0""",
)
oracle(
    "first_batch_text",
    "padded vocab",
    f"""select rank, slot, pair_id, {spoken("ids")} as input_text
        from padded, (select list(token order by id) as words from vocab)
        where split = 'train' and epoch = 0 and batch = 0""",
)

# -- preference sequences -------------------------------------------------------------------------------------------

for name in ("pref_pairs", "pref_messages"):
    oracle(name, "prefs", "select pair_id, prompt, chosen, rejected from prefs")


oracle(
    "pref_turns",
    "prefs",
    """select pair_id, 'user: ' || prompt || chr(10) || chr(10) || 'assistant: ' || chosen || chr(10) || chr(10)
              || 'user: ' || rejected as prompt, chosen, rejected from prefs""",
)
oracle("dataset_split", "prefs", "select p, pair_id, chosen from prefs where p % 3 <> 0 and p >= 10")
oracle("dataset_stream", "prefs", "select p, pair_id, chosen from prefs where p % 3 <> 0")
oracle("pref_split", "prefs", "select pair_id, prompt, chosen, rejected from prefs where p % 3 = 0")


def sequences(ids: str, loss_mask: str) -> str:
    """Sequences nr the start of rows of the batch's width, with labels and loss mask moved by one place."""
    return f"""select batch, p, pair_id, side, ids, attention, labels, loss_mask, width from (
        select *, list_concat(ids0[2:], ids0[:1]) as labels, list_concat(mask0[2:], mask0[:1]) as loss_mask, ids0 as ids from (
          select batch, p, pair_id, side, width, list_concat(s, {fill("sp.pad", "width - len(s)")}) as ids0,
                 list_concat(m, {fill("0", "width - len(s)")}) as mask0,
                 list_concat({fill("1", "len(s)")}, {fill("0", "width - len(s)")}) as attention
          from (select *, max(len(s)) over (partition by batch) as width
                from (select *, {ids} as s, {loss_mask} as m from pref_rows)), sp))"""


def sequence_rows(ids: str, loss_mask: str) -> str:
    return f"""select batch, pair_id, side, {text("ids")} as input_ids, {text("attention")} as attention_mask,
        {text("loss_mask")} as loss_mask, {text("labels")} as labels, list_sum(loss_mask)::bigint as completion_length
        from ({sequences(ids, loss_mask)})"""


oracle("pref_sequences", "pref_rows sp", sequence_rows("ids", "loss_mask"))
oracle("pref_truncate_start", "pref_rows sp", sequence_rows("ids[:160]", "loss_mask[:160]"))
LAST = "[greatest(len(ids) - 160, 0) + 1:]"
for name in ("pref_truncate_end", "pref_sequences_padded"):
    oracle(name, "pref_rows sp", sequence_rows(f"ids{LAST}", f"loss_mask{LAST}"))
oracle(
    "pref_logits_to_keep",
    "pref_rows sp",
    f"""select batch, pair_id, side, k as logits_to_keep, {text("labels[greatest(width - k, 0) + 1:]")} as labels,
               {text("loss_mask[greatest(width - k, 0) + 1:]")} as loss_mask,
               {text("ids[greatest(width - k, 0) + 1:]")} as aligned_ids
        from (select s.*, (width - k0 + 1)::integer as k from ({sequences("ids", "loss_mask")}) s
              join (select batch, min(len(prompt_ids)) as k0 from pref_rows group by batch) using (batch))""",
)
oracle(
    "pref_packed",
    "pref_rows",
    f"""select batch, {text("list(len(ids) order by side, p)")} as lengths,
               {text("flatten(list(ids order by side, p))")} as input_ids,
               {text("flatten(list(loss_mask order by side, p))")} as loss_mask,
               {text("flatten(list(range(len(ids)) order by side, p))")} as position_ids
        from pref_rows group by batch""",
)
oracle("pref_unpacked", "pref_rows", f"select batch, p, side, {text('ids')} as input_ids from pref_rows")
oracle(
    "pref_encoder_labels",
    "pref_rows sp",
    f"""select batch, pair_id, side,
               {text(f"list_concat({fill('sp.pad', 'pw - len(prompt_ids)')}, prompt_ids)")} as prompt_input_ids,
               {text(f"list_concat({fill('0', 'pw - len(prompt_ids)')}, {fill('1', 'len(prompt_ids)')})")} as prompt_attention_mask,
               {text(f"list_concat(completion_ids, {fill('-100', 'cw - len(completion_ids)')})")} as labels
        from (select *, max(len(prompt_ids)) over (partition by batch) as pw,
                     max(len(completion_ids)) over (partition by batch) as cw from pref_rows), sp""",
)

# -- losses and rewards ---------------------------------------------------------------------------------------------

LOSS = "greatest(-x, 0) + ln(1 + exp(-abs(x)))"


def losses(sums: str, x: str) -> str:
    return f"""select *, {LOSS} as loss from (
        select p, pair_id, p // 8 as batch, chosen_length, rejected_length, pc, pr, rc, rr, {x} as x,
               0.1 * (pc - rc) as chosen_reward, 0.1 * (pr - rr) as rejected_reward from {sums})"""


PAIR = f"""select pair_id, chosen_length, rejected_length, {r4("pc")} as chosen_logp, {r4("pr")} as rejected_logp,
       {r4("chosen_reward")} as chosen_reward, {r4("rejected_reward")} as rejected_reward,
       {r4("chosen_reward - rejected_reward")} as reward_margin,
       (chosen_reward > rejected_reward)::integer::double as accuracy, {r4("loss")} as loss"""
SCALED = "0.1 * ((pc - pr) - (rc - rr))"
REGUL = f"{SCALED} + 0.4 * (chosen_length - rejected_length)"
NORMALISED = """(select p, pair_id, chosen_length, rejected_length, pc / chosen_length as pc, pr / rejected_length as pr,
                        rc / chosen_length as rc, rr / rejected_length as rr from score_sums)"""
DESENSITISED = """(select p, pair_id, chosen_length, rejected_length, rc, rr,
      sum(policy * case when nr <= least(chosen_length, rejected_length) then 1 else 0.4 end) filter (side = 'chosen') as pc,
      sum(policy * case when nr <= least(chosen_length, rejected_length) then 1 else 0.4 end) filter (side = 'rejected') as pr
      from score_rows join score_sums using (p, pair_id) group by all)"""

oracle("dpo_regul", "score_sums", f"{PAIR} from ({losses('score_sums', REGUL)})")
oracle("dpo_ipo", "score_sums", f"{PAIR} from ({losses(NORMALISED, REGUL)})")
for name in ("dpo_ld", "dpo_token_rows"):
    oracle(name, "score_sums score_rows", f"{PAIR} from ({losses(DESENSITISED, SCALED)})")
oracle(
    "dpo_user_loss",
    "score_sums",
    f"select pair_id, {r4('greatest(0, 1 - x)')} as loss from ({losses('score_sums', REGUL)})",
)


def means(prefix: str = "") -> str:
    named = {
        "rewards_chosen": "avg(chosen_reward)",
        "rewards_rejected": "avg(rejected_reward)",
        "rewards_accuracies": "avg((chosen_reward > rejected_reward)::integer)",
        "rewards_margins": "avg(chosen_reward - rejected_reward)",
        "logps_chosen": "avg(pc)",
        "logps_rejected": "avg(pr)",
    }
    values = ", ".join(f"{r4(value)} as {prefix}{name}" for name, value in named.items())
    return f"count(*) as pairs, {r4('avg(loss)')} as loss, {values}"


oracle(
    "dpo_metrics",
    "score_sums",
    f"select batch, max(chosen_length) as longest_chosen, {means()} from ({losses('score_sums', REGUL)}) group by batch",
)
oracle("dpo_eval_metrics", "score_sums", f"select {means('eval_')} from ({losses('score_sums', REGUL)})")
oracle(
    "dpo_metrics_exact",
    "score_sums",
    f"""select batch, name, count(*) as pairs, round(avg(value), 6) + 0.0 as mean from (
          select unnest([batch, null]) as batch, name, value from (
            unpivot (select batch, loss, chosen_reward as rewards_chosen, chosen_reward - rejected_reward as rewards_margins,
                            (chosen_reward > rejected_reward)::integer::double as rewards_accuracies
                     from ({losses('score_sums', REGUL)}))
            on loss, rewards_chosen, rewards_margins, rewards_accuracies into name name value value))
        group by batch, name""",
)
oracle(
    "dpo_reference_join",
    "score_sums",
    f"""select pair_id, {r4("rc")} as ref_chosen_logp, {r4("rr")} as ref_rejected_logp, {r4("loss")} as loss
        from ({losses('score_sums', REGUL)})""",
)
oracle(
    "label_logp",
    "place_scores",
    f"""select request_id, {r4("logp")} as logp, {r4("lse2")} as lse2, {r4("logit_sum")} as logit_sum, logit_count
        from place_scores where scale = 10""",
)
oracle(
    "label_logp_long",
    "place_scores",
    f"""select request_id, {r4("logp")} as logp, {r4("logit_sum")} as logit_sum, logit_count
        from place_scores where scale = 10""",
)
oracle(
    "sequence_logp",
    "place_sums",
    f"""select pair_id, case side when 0 then 'chosen' else 'rejected' end as side, length, nll_count,
               {r4("logp")} as logp, {r4("coalesce(nll_sum, 0)")} as nll_sum from place_sums where scale = 10""",
)
oracle(
    "sequence_logp_encoder",
    "place_sums",
    f"""select pair_id, case side when 0 then 'chosen' else 'rejected' end as side, length, nll_count_all as nll_count,
               {r4("logp")} as logp, {r4("nll_sum_all")} as nll_sum from place_sums where scale = 10""",
)
oracle(
    "dpo_rpo",
    "logit_losses",
    f"""select pair_id, chosen_length, {r4("pc")} as chosen_logp, {r4("rc")} as ref_chosen_logp, {r4("nll")} as nll_loss,
               {r4("loss + 0.5 * nll")} as loss from logit_losses""",
)
oracle(
    "dpo_weighted",
    "logit_losses",
    f"select pair_id, {r4('weight')} as policy_weight, {r4('loss * weight')} as loss from logit_losses",
)
oracle("dpo_aux", "logit_losses", f"select pair_id, {r4('loss + 0.01 * (chosen_logits / 100)')} as loss from logit_losses")
oracle(
    "dpo_logit_metrics",
    "logit_losses",
    f"""select batch, {means()}, {r4("sum(chosen_logits) / sum(chosen_count)")} as logits_chosen,
               {r4("sum(rejected_logits) / sum(rejected_count)")} as logits_rejected, {r4("avg(nll)")} as nll_loss
        from (select batch, pc, pr, loss + 0.5 * nll as loss, nll, chosen_logits, chosen_count, rejected_logits,
                     rejected_count, 0.1 * (pc - rc) as chosen_reward, 0.1 * (pr - rr) as rejected_reward
              from logit_losses) group by batch""",
)

# -- choice of the next token ---------------------------------------------------------------------------------------

TOP = "select *, 10 * value as logit, rank() over (partition by request_id order by value desc) as place from logits"
oracle(
    "topk_softmax",
    "logits",
    f"""select request_id, token_id, {r4("w / sum(w) over (partition by request_id)")} as probability from (
          select request_id, token_id, exp((logit - max(logit) over (partition by request_id)) / 0.7) as w
          from ({TOP}) where place <= 5)""",
)
oracle("topk_long", "logits", f"select request_id, token_id, {r4('logit')} as logit from ({TOP}) where place <= 5")
for name in ("greedy", "greedy_long"):
    oracle(
        name,
        "logits",
        """select request_id, token_id from logits
           qualify row_number() over (partition by request_id order by value desc, token_id) = 1""",
    )
UNIFORM = "(('0x' || substr(md5('42|' || request_id || '|' || token_id), 1, 13))::bigint + 0.5) / 4503599627370496"
oracle(
    "sampled",
    "logits",
    f"""select request_id, token_id from ({TOP}) where place <= 20
        qualify row_number() over (partition by request_id order by logit / 0.8 - ln(-ln({UNIFORM})) desc, token_id) = 1""",
)
for name in ("repetition", "repetition_long"):
    oracle(
        name,
        "logits",
        f"""select request_id, token_id, {r4('''case
              when token_id not in (label_id, request_id % 64, request_id * 7 % 64) then 10 * value
              when value > 0 then 10 * value / 1.1 else 10 * value * 1.1 end''')} as logit from logits""",
    )
oracle(
    "crop_context",
    "prepared",
    f"select pair_id, {text('ids[greatest(len(ids) - 100, 0) + 1:]')} as ids from prepared",
)

# -- responses ------------------------------------------------------------------------------------------------------

oracle(
    "compare_responses",
    "pairs",
    "select pair_id as prompt_id, instruction, instruction as base_response, response as tuned_response from pairs",
)
oracle(
    "responses_tuned_only",
    "pairs",
    "select pair_id as prompt_id, instruction, null::varchar as base_response, response as tuned_response from pairs",
)
oracle(
    "response_cut",
    "prepared vocab",
    """select pair_id, coalesce(string_agg(case when special then '' else token end, '' order by nr), '') as response
       from (select pair_id, unnest(ids) as id, generate_subscripts(ids, 1) as nr, n_prompt from prepared)
       join vocab using (id) where nr > n_prompt group by pair_id""",
)
oracle(
    "generate_bigram",
    "pairs prepared vocab sp",
    f"""select request_id, coalesce({text("list(id order by step) filter (id is not null)")}, '') as new_ids,
               coalesce(string_agg(case when special then '' else token end, '' order by step), '') as response
        from (select request_id from asked) left join (select * from grown where step > 0) using (request_id)
        left join vocab using (id) group by request_id""",
)
ORACLE["generate_bigram"] = ORACLE["generate_bigram"].replace(
    "\nselect request_id, coalesce(",
    f""",
asked as materialized (
    select pair_id as request_id, {SYSTEM_V1} || {INSTRUCTION} || instruction || {RESPONSE} as prompt from pairs
    union all
    select 'default-' || nr, {SYSTEM_V1} || {INSTRUCTION} || instruction || {RESPONSE} from (values
      (1, 'Research and summarize the common practices for caring of rabbits.'),
      (2, 'Generate a list of 5 books that discuss the theme of resilience'),
      (3, 'Identify the key characters of the novel ' || chr(39) || 'The Hobbit' || chr(39)),
      (4, 'Write a function which reverses the order of words in a sentence.'),
      (5, 'Generate a list of five advantages of using a certain product.')) d(nr, instruction)),
following as materialized (select prev, next from (
    select prev, next, row_number() over (partition by prev order by count(*) desc, next) as place
    from (select unnest(ids[1:len(ids) - 1]) as prev, unnest(ids[2:]) as next from prepared) group by prev, next)
    where place = 1),
grown as (
    select request_id, 0 as step, coalesce(v.id, sp.unk) as id
    from (select request_id, {cut("prompt")}[-1] as token from asked) left join vocab v using (token), sp
    union all
    select request_id, step + 1, next from grown join following on prev = id, sp
    where step < 100 and next <> sp.eos)
select request_id, coalesce(""",
    1,
)

ORACLE["generate_recursive"] = ORACLE["generate_bigram"]

# -- training logs --------------------------------------------------------------------------------------------------


def averages(aggregate) -> str:
    phases = ("forward", "backward", "build_batch", "optimizer_step")
    return ", ".join(f"{aggregate(phase)} as ms_{phase}" for phase in phases)


def windows(steps: str, freq: int, rows: str = "count(distinct global_step)", times: int = 1) -> str:
    return f"""select run_id, step as global_step, floor((step - 1) / 25)::integer as epoch,
    25 - ((step - 1) % 25 + 1) + 1 as batches_remaining, 4 * 8 * 256::bigint as tokens_per_step,
    round(1e9 * (1e-6 + 9e-6 * (1 + cos(pi() * step / 100)) / 2), 4) as lr_e9,
    {r4(f"loss / {freq}")} as running_loss, {r4("((step - 1) % 25 + 1) / 25")} as epoch_progress,
    {averages(lambda phase: r4(f"ms_{phase}"))}, {r4("ms")} as ms_per_step, {r4("1000 * (8192 / ms)")} as tokens_per_s
  from (select *, ms_forward + ms_backward + ms_build_batch + ms_optimizer_step as ms from (
    select run_id, (global_step - 1) // {freq} as w, max(global_step) as step, sum(loss) as loss,
           {averages(lambda phase: f"1000 * avg(elapsed_s) filter (ok and phase = '{phase}')")}
    from {steps} group by run_id, w having {rows} = {freq * times}))"""

oracle("run_steps", "steps", "select * from steps")
for name in ("run_windows", "metric_sink", "stream_windows"):
    oracle(name, "steps", windows("steps", 20))
for name in ("run_windows_phases", "stream_windows_phases"):
    oracle(name, "phase_steps", windows("phase_steps", 5))

oracle(
    "run_loss_exact",
    "steps",
    """select run_id, (global_step - 1) // 20 as window, count(loss) as n, round(sum(loss), 6) + 0.0 as loss
       from steps group by run_id, (global_step - 1) // 20 having count(loss) > 0""",
)
oracle("stream_windows_live", "phase_steps", windows("phase_steps", 5, "count(*)", 4))

STEPS = """select epoch, batch, (batch + 1)::integer as epoch_step, epoch * batches + batch + 1 as global_step, batches
    from (select distinct epoch, batch from plan where split = 'train' and rank = 0),
         (select count(distinct batch) as batches from plan where split = 'train' and rank = 0)"""
oracle(
    "lr_schedule",
    "plan",
    f"""select epoch, batch, epoch_step, global_step,
               round(1e9 * (1e-6 + 9e-6 * (1 + cos(pi() * global_step / (3 * batches))) / 2), 4) as lr_e9 from ({STEPS})""",
)
oracle(
    "checkpoint_steps",
    "plan",
    f"""select global_step, global_step % 4 = 0 as logs, global_step % 5 = 0 or epoch_step = batches as saves_epoch,
               global_step % 5 = 0 or global_step = 3 * batches as saves_run from ({STEPS})""",
)
oracle(
    "run_record",
    "plan plan_single splits",
    """select 'sharded' as run_id, rows as training_rows, batches * 4 as num_batches, 4 as world_size, false as resumed
       from (select count(distinct batch) as batches from plan where split = 'train' and rank = 0),
            (select count(*) as rows from splits where split = 'train')
       union all
       select 'single', batches * 8, batches, 1, true
       from (select count(distinct batch) as batches from plan_single where split = 'train')""",
)
for name, table in (("resume_state", "steps"), ("resume_state_phases", "phase_steps")):
    oracle(
        name,
        table,
        f"""select run_id::varchar as run_id, floor((global_step - 1) / 25)::integer as epoch, global_step,
               ((global_step - 1) % 25 + 1)::integer as epoch_step,
               {r4("case when global_step % 20 = 0 then 0.0 else running end")} as running_loss
        from (select *, sum(loss) over (partition by run_id, (global_step - 1) // 20 order by global_step) as running
              from (select run_id, global_step, sum(loss) as loss from {table} group by run_id, global_step))
        where global_step % 30 = 0 or global_step % 25 = 0
        qualify row_number() over (partition by run_id order by global_step desc) = 1""",
    )

# -- streams --------------------------------------------------------------------------------------------------------

for name in ("stream_prepare", "stream_prepare_joined"):
    oracle(
        name,
        "doc_pairs vocab sp",
        f"""select pair_id, n_tokens, n_prompt, {text("list(coalesce(v.id, sp.unk) order by nr)")} as input_ids
        from (select pair_id, len(tokens)::integer as n_tokens,
                     len({cut("substr(body, 1, instr(body, '###Response:' || chr(10)) + 12)")})::integer as n_prompt,
                     unnest(tokens) as token, generate_subscripts(tokens, 1) as nr
              from (select pair_id, body, {cut("body")} as tokens from (
                      select pair_id, {SYSTEM_V2} || {INSTRUCTION} || instruction || {RESPONSE} || response || {EOS} as body
                      from doc_pairs)) where len(tokens) < 1024)
        left join vocab v using (token), sp group by pair_id, n_tokens, n_prompt""",
    )
