"""Training-data operators: decontamination, language-model scoring, HTML text,
packing, quality rules, license scans, chat windows, a quality classifier,
substring and SimHash near-duplicates.  Nothing outside this subpackage imports it."""
