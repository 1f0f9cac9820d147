"""DataFrame → DataFrame building blocks.

reshape    unpivot (Expand) and pivot with explicit values (R1–R4, P10)
aggregate  missing-propagating grouped sums, national roll-up (A1–A5)
join       name lookup after aggregation, bounded broadcast, anti-join (J1, J2)
setops     by-name unions, distinct, code sort, export order (U1–U3, D1, O1, O2)
quality    source audit, code-domain guard, fail-fast decades (S13, D2, D3)
"""
