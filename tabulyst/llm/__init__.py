"""Training-data operators: cleaning, deduplication, scoring and packing of a text corpus.

Task functions refer to these modules by name, as they share tables that are too large to send with each task: install the
package on the executors, or pass it with --py-files.
"""
