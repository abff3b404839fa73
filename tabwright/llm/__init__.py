"""Training-data operators: archives, near copies, token counts, filters, packing, language-model scores."""
