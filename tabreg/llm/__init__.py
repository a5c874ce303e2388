"""Operations of a large-scale training-data pipeline over document and vector tables.

Thirteen operators, one module each; ``catalog`` registers one query per operator and the
pipeline. Nothing else in the library imports this subpackage.
"""
