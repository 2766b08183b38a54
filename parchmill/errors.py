"""What stops a document or a run, with its class name as error_class."""


class IngestionError(Exception):
    pass


class UnsupportedFormatError(IngestionError):
    pass


class DocumentParseError(IngestionError):
    pass


class ConfigurationError(IngestionError):
    pass


class EmbeddingError(IngestionError):
    pass


class IndexingError(IngestionError):
    pass
