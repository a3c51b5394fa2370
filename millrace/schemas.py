"""Fixed schemas, as DDL, of the tables and documents the library reads and writes."""

USER_KEYS = ("id", "organization_id", "connected_integration_id")
TENANT = ("organization_id", "connected_integration_id")
#: What the content hash of users is taken of, in every table that has it.
HASH_OF = ("name", "email")

EXTRACTED_USER = (
    "id string, external_id string, organization_id string, connected_integration_id string, "
    "name string, email string"
)
USERS_STAGING = (
    "id string, workflow_id string, external_id string, organization_id string, "
    "connected_integration_id string, name string, email string, content_hash string, "
    "created_at timestamp_ntz, batch_seq bigint"
)
USERS_LATEST = (
    "id string, external_id string, organization_id string, connected_integration_id string, "
    "name string, email string, content_hash string, last_updated timestamp_ntz"
)
USERS_CDC = (
    "id string, workflow_id string, external_id string, organization_id string, "
    "connected_integration_id string, name string, email string, content_hash string, "
    "change_type string, detected_at timestamp_ntz"
)
CONNECTED_INTEGRATIONS = "id string, organization_id string, provider string, provider_data string"
ACCESS_REQUESTS = (
    "id string, user_id string, access_id string, status string, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)
ERRORS = "id string, message string, created_at timestamp_ntz"
TASKS = "id string, title string, data string, created_at timestamp_ntz"

REQUEST_STATUSES = ("requested", "approved", "rejected", "canceled")

# The nested people document. postcode is a string because sources mix numbers and text.
PERSON = (
    "gender: string, name: struct<title: string, first: string, last: string>, "
    "location: struct<street: struct<number: int, name: string>, city: string, state: string, "
    "country: string, postcode: string, coordinates: struct<latitude: string, longitude: string>, "
    "timezone: struct<offset: string, description: string>>, email: string, "
    "login: struct<uuid: string, username: string, password: string, salt: string, md5: string, "
    "sha1: string, sha256: string>, dob: struct<date: string, age: int>, "
    "registered: struct<date: string, age: int>, phone: string, cell: string, "
    "id: struct<name: string, value: string>, "
    "picture: struct<large: string, medium: string, thumbnail: string>, nat: string"
)


def document_of(element: str) -> str:
    """Schema of a document ``{"results": [element, ...], "info": {...}}``."""
    return (
        f"results array<struct<{element}>>, "
        "info struct<seed: string, results: int, page: int, version: string>, "
        "_corrupt_record string"
    )


PEOPLE_DOCUMENT = document_of(PERSON)
