-- The fixed clinical check as SQL; lintel/operators/clinical.py has the same check as DataFrame code.
-- Parameters: :review_date (date text), :stale_days (int).
--
-- Each record gets the list of its issues in order of priority and keeps the first.
-- Keys that hold more than a thousandth of all records (fewer than 1,000 of them can exist)
-- are counted by a broadcast; their records then take a lane of their own in the join with
-- the other repeated keys, where they meet nothing and spread over all tasks.
WITH repeated AS (
    SELECT patient_id, source, field_name, count(*) AS copies
    FROM {records}
    GROUP BY ALL
    HAVING copies > 1
),
bound AS (SELECT count(*) / 1000 AS most FROM {records}),
met AS (
    SELECT /*+ BROADCAST(f) */
           r.record_id, r.patient_id, r.source, r.field_name, r.value, r.unit, r.expected_unit,
           r.ref_low, r.ref_high, r.data_received_date, f.copies AS hot_copies,
           if(f.copies IS NULL, 0, 1 + pmod(xxhash64(r.record_id, r.value, r.data_received_date), 100000)) AS lane
    FROM {records} r
    LEFT JOIN (SELECT * FROM repeated WHERE copies > (SELECT most FROM bound)) f
      ON r.patient_id <=> f.patient_id AND r.source <=> f.source AND r.field_name <=> f.field_name
),
listed AS (
    SELECT m.* EXCEPT (hot_copies, lane),
           array_compact(array(
               if(m.value IS NULL, 'missing_value', NULL),
               if(m.unit <> m.expected_unit, 'unit_mismatch', NULL),
               if(coalesce(m.hot_copies, c.copies) IS NOT NULL, 'duplicate_measurement', NULL),
               if(date_add(m.data_received_date, :stale_days) < to_date(:review_date), 'stale_data', NULL),
               if(m.ref_low IS NOT NULL AND m.ref_high IS NOT NULL AND NOT m.value BETWEEN m.ref_low AND m.ref_high,
                  'out_of_range', NULL))) AS found
    FROM met m
    LEFT JOIN (SELECT * FROM repeated WHERE copies <= (SELECT most FROM bound)) c
      -- pmod(copies, 1) is 0, the lane of all records without a hot key; a plain 0 would be folded out of the exchange.
      ON m.lane = pmod(c.copies, 1)
     AND m.patient_id <=> c.patient_id AND m.source <=> c.source AND m.field_name <=> c.field_name
)
SELECT * EXCEPT (found), found[0] AS issue_type
FROM listed
WHERE size(found) > 0
