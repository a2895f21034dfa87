"""Training-data operators: tokens, packing, fingerprints, classifiers,
near duplicates and personal data. Nothing else in the library imports
this subpackage; its queries are in `callscope.llm.queries`."""
