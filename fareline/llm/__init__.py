"""Training-data operators for text corpora, web pages and conversations.

One module per operator, ``queries`` registers them. Nothing outside this
package imports it; it only borrows general helpers from the library.
"""
