from conftest import SF001

from canopus.sources.tags import documents_as_tag_lines, read_documents


def documents_lines(spark, sf=SF001):
    return documents_as_tag_lines(read_documents(spark, sf))
