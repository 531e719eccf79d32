"""Jobs built from the operators: reconciliation of staged legacy tables
(``transform``), publishing to target tables (``transfer``) and the query set
over the star-schema test tables (``star``)."""
